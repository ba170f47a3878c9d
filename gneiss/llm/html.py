"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with its path of block-level tags and their classes from the root.
Text length and punctuation are summed over all blocks of a path and divided by their number; both ratios
are smoothed over the sequence of blocks with a Gaussian, fused as a product, and paths whose mean reaches a
share of the deviation and of the best path are content.  What a page says about its elements only weighs: an article or
main tag raises its paths, a mark (a role, hidden, or a class or id that is nothing but words for menus,
notices, adverts, comments and the like) lowers them.  Marks on elements that hold more than half of the text say
nothing and are lifted, largest element first, until half of the text is unmarked.

Around the content, the outermost article (or else main) tag that holds nearly all of it brings its other
unmarked blocks (headings, references); without one the smallest element that holds all content brings its
headings, paragraphs and lists and those directly in an element around it (body aside), unless they are mostly
links.  A block whose path is content is never dropped.  Scripts, styles, forms, and nav, footer, aside and
(outside an article) header tags are no text of the article by definition and are not read.

Defined results: null and empty pages, pages without any text, and pages whose article or main tag is empty
while all other text is marked, give the empty text; a broken tag ends where the next tag begins, and after the
first tag that ends in an open quote no quoted value goes beyond a "<"; paths that tie with a threshold are content;
equal rows give equal rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from gneiss.llm.shingles import texts

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
LEFT_OUT = {"nav", "footer", "aside", "form", "button", "select", "fieldset", "dialog", "menu", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "toolbar"}
#: Words of class and id values that name something else than main text.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disclaimer", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "related", "replies", "reply", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "topbar", "disqus"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "blockquote", "pre", "figcaption", "td", "th", "caption"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Content reaches so many deviations, and such a share of the best path; blocks on each side that smooth.
DEVIATIONS, SHARE, RADIUS = 0.5, 0.25, 2
#: Weights of paths inside an article or main tag, and of marked paths.
RAISED, LOWERED = 10.0, 0.05


def _tokens(quoted: str) -> re.Pattern:
    """Comments, raw elements, tags, and anything else that begins like a tag."""
    rest = rf"""(?:[^"'<>]++|"{quoted}"|'{quoted.replace('"', "'")}')*+"""
    return re.compile(
        rf"<!--.*?(?:-->|\Z)|<(?P<raw>{'|'.join(sorted(RAW))})\b{rest}>.*?(?:</(?P=raw)\s*>|\Z)"
        rf"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<rest>{rest})(?:>|(?=<)|\Z)|(?P<torn><[a-z/!?][^<>]*+>?)",
        re.IGNORECASE | re.DOTALL,
    )


_TOKEN, _STRICT = _tokens('[^"]*+'), _tokens('[^"<]*+')


def _scan(html: str):
    """Token matches in order, in time linear in the page."""
    for m in _TOKEN.finditer(html):
        yield m
        if m["torn"] and (m["torn"][1:2].isalpha() or m["torn"][2:3].isalpha() and m["torn"][1] == "/"):
            yield from _STRICT.finditer(html, m.end())
            return


_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?+|"[^"]*+"|'[^']*+'""")
_WORD, _DIGITS = re.compile(r"[a-z]+"), re.compile(r"\d+")
_PUNCTUATION = re.compile(r"[.,;:!?…，。、！？；：«»]")
_KERNEL = [math.exp(-(k * k) / 2) for k in range(-RADIUS, RADIUS + 1)]


class Block:
    """Text between two block-level tags: the innermost element around it, that element's path, and the text inside links."""

    __slots__ = ("element", "path", "text", "linked")

    def __init__(self, element, path, text, linked):
        self.element, self.path, self.text, self.linked = element, path, text, linked


class Page:
    """Blocks in order, and the elements in the order they open (0 is the root, a parent comes before its children)."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.parent, self.tag, self.marked, self.away, self.path, self.named = [0], [""], [False], [False], [0], [False]
        self._paths: dict[tuple[int, str], int] = {}

    def open(self, parent: int, tag: str, classes: str, marked: bool, away: bool) -> int:
        label = f"{tag}.{classes}!" if marked else f"{tag}.{classes}"
        self.parent.append(parent)
        self.tag.append(tag)
        self.marked.append(marked)
        self.away.append(away)
        self.path.append(self._paths.setdefault((self.path[parent], label), len(self._paths) + 1))
        self.named.append(self.named[parent] or tag in ("article", "main"))
        return len(self.tag) - 1

    def held(self, sizes: dict[int, int]) -> list[int]:
        """For each element the sum of ``sizes`` (by element) within it."""
        total = [0] * len(self.tag)
        for e, n in sizes.items():
            total[e] += n
        for e in range(len(total) - 1, 0, -1):
            total[self.parent[e]] += total[e]
        return total


def _is_left_out(tag: str, inside: bool) -> bool:
    return tag in LEFT_OUT or tag == "header" and not inside


def _attributes(rest: str, inside: bool) -> tuple[str, bool]:
    """The classes, digits aside, and whether the element is marked."""
    classes, marked = "", False
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value in ROLES:
            marked = True
        if name == "class":
            classes = " ".join(sorted(set(_DIGITS.sub("", value).split())))
        if name in ("class", "id"):
            for token in value.split():  # a mark is a whole token, as it is or made of nothing but marks
                words = _WORD.findall(token)
                if words and all(w in MARKS or not inside and w == "header" for w in words):
                    marked = True
    return classes, marked


def read(html: str) -> Page:
    """The page's blocks and elements, without the blocks of elements that are left out by their tag."""
    page = Page()
    stack = [0]
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text and not page.away[stack[-1]]:
                page.blocks.append(Block(stack[-1], page.path[stack[-1]], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    at, opened = 0, Counter()
    for m in _scan(html):
        if m.start() > at:
            piece = html[at : m.start()]
            parts.append(piece)
            if links:
                linked += len(piece.strip())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m["end"] else 1
            continue
        if tag in ("br", "wbr", "img", "input", "embed"):
            parts.append("" if tag == "wbr" else " ")
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if m["end"]:
            while opened[tag]:
                last = page.tag[stack.pop()]
                opened[last] -= 1
                if last == tag:
                    break
            continue
        if page.tag[stack[-1]] == "p":
            opened["p"] -= 1
            stack.pop()
        ends = CLOSES.get(tag)
        if ends and page.tag[stack[-1]] in ends:
            opened[page.tag[stack.pop()]] -= 1
            if tag == "tr" and page.tag[stack[-1]] == "tr":
                opened["tr"] -= 1
                stack.pop()
        if tag == "body":  # what the head left open ends here
            for e in stack[2:]:
                opened[page.tag[e]] -= 1
            del stack[2:]
            for e in stack:
                page.away[e] = False
        rest = m["rest"]
        top = stack[-1]
        if not rest.rstrip().endswith("/") or tag in ("p", "div", "body", "article"):
            inside = page.named[top]
            away = page.away[top] or _is_left_out(tag, inside)
            classes, marked = _attributes(rest, inside) if rest and not away else ("", False)
            stack.append(page.open(top, tag, classes, marked and tag not in ("html", "body", "article", "main"), away))
            opened[tag] += 1
    if at < len(html):
        parts.append(html[at:])
    flush()
    return page


def lowered(page: Page) -> list[bool]:
    """For each element whether it is in a marked one, marks lifted until half of the text is unmarked.

    Only the text of article and main tags counts where some of it is unmarked.  Where such a tag is there, but
    none has text, no mark is lifted.
    """
    near = [0] * len(page.tag)  # the innermost marked element around
    for e in range(1, len(near)):
        near[e] = e if page.marked[e] else near[page.parent[e]]
    scope = page.blocks
    if any(page.named[b.element] for b in scope):
        if any(page.named[b.element] and not near[b.element] for b in scope):
            scope = [b for b in scope if page.named[b.element]]
    elif any(page.named):
        return [e > 0 for e in near]
    sizes: Counter[int] = Counter()
    own: Counter[int] = Counter()
    for b in scope:
        sizes[b.element] += len(b.text)
        own[near[b.element]] += len(b.text)
    held, total, clean, lifted = page.held(sizes), sum(sizes.values()), own[0], {0}
    for e in sorted((e for e in range(len(near)) if page.marked[e] and held[e]), key=lambda e: (-held[e], e)):
        if 2 * clean >= total:
            break
        lifted.add(e)  # those around it are larger, or as large and opened before, and so lifted already
        clean += own[e]
    return [e not in lifted for e in near]


def _smooth(series: list[float]) -> list[float]:
    out = []
    for i in range(len(series)):
        lo, hi = max(0, i - RADIUS), min(len(series), i + RADIUS + 1)
        weights = _KERNEL[lo - i + RADIUS : hi - i + RADIUS]
        out.append(sum(w * x for w, x in zip(weights, series[lo:hi], strict=True)) / sum(weights))
    return out


def content_paths(found: list[Block], weight: list[float]) -> set[int]:
    """Paths whose smoothed and fused ratios, times the weights of their blocks, reach both thresholds.

    Smoothing raises a ratio to twice its own at most, so the neighbours of long text aren't taken for it.
    """
    sums: dict[int, list[int]] = {}
    for b in found:
        own = sums.setdefault(b.path, [0, 0, 0])
        own[0] += len(b.text) - b.linked
        own[1] += len(_PUNCTUATION.findall(b.text))
        own[2] += 1
    length, points = ([sums[b.path][k] / sums[b.path][2] for b in found] for k in (0, 1))
    fused = [min(a, 2 * x) * (min(c, 2 * y) + 0.1) * w for a, x, c, y, w in zip(_smooth(length), length, _smooth(points), points, weight, strict=True)]
    mean = sum(fused) / len(fused)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    score: dict[int, float] = dict.fromkeys(sums, 0.0)
    for b, x in zip(found, fused, strict=True):
        score[b.path] += x / sums[b.path][2]
    best = max(score.values())
    return {p for p, x in score.items() if x >= min(best, max(DEVIATIONS * deviation, SHARE * best))}


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line feeds."""
    page = read(html or "")
    low = lowered(page)
    found = page.blocks
    if any(page.named) and not any(page.named[b.element] for b in found):  # the article is empty: no marked text stands in for it
        found = [b for b in found if not low[b.element]]
    if not found:
        return ""
    chosen = content_paths(found, [(RAISED if page.named[b.element] else 1.0) * (LOWERED if low[b.element] else 1.0) for b in found])
    sizes: Counter[int] = Counter()
    for b in found:
        if b.path in chosen:
            sizes[b.element] += len(b.text)
    held, total = page.held(sizes), sum(sizes.values())
    outer = [e for e in range(len(held)) if page.tag[e] not in PROSE]
    named = next((e for tag in ("article", "main") for e in outer if page.tag[e] == tag and 10 * held[e] >= 9 * total), 0)
    around = [e for e in outer if held[e] == total]
    holder = named or around[-1]
    beside = set() if named else {e for e in around if page.tag[e] not in ("", "html", "body")}
    inside, home = [holder == 0] * len(held), [0] * len(held)
    for e in range(1, len(held)):
        inside[e] = e == holder or inside[page.parent[e]]
        home[e] = home[page.parent[e]] if page.tag[e] in PROSE else e
    out = []
    for b in found:
        e = b.element
        prose = page.tag[e] in PROSE and 2 * b.linked <= len(b.text)
        if b.path in chosen or not low[e] and (inside[e] and (named or prose) or prose and home[e] in beside):
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    pages = pages.select("page_id", "url", "html")

    def run(batches):
        for batch in texts(batches, at=2):
            found = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
