"""A page as flat tables: texts in order, and elements with the span of texts that each holds."""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style"}


class Page(HTMLParser):
    """Parallel lists by element number (0 is the page): name, attributes, parent, and first and end of its texts."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.name, self.attributes, self.parent, self.first, self.end = [""], [{}], [0], [0], [0]
        self._open = [0]
        self.feed(html or "")
        self.close()
        for e in self._open:
            self.end[e] = len(self.texts)

    def handle_starttag(self, tag, attrs):
        self.name.append(tag)
        self.attributes.append({k: v or "" for k, v in attrs})
        self.parent.append(self._open[-1])
        self.first.append(len(self.texts))
        self.end.append(len(self.texts))
        if tag not in VOID:
            self._open.append(len(self.name) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._open.pop()

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self._open) - 1, 0, -1) if self.name[self._open[k]] == tag), None)
        if at is not None:
            for e in self._open[at:]:
                self.end[e] = len(self.texts)
            del self._open[at:]

    def handle_data(self, data):
        text = " ".join(data.split())
        if text and self.name[self._open[-1]] not in SILENT:
            self.texts.append(text)

    def text(self, e: int = 0) -> str:
        return " ".join(self.texts[self.first[e] : self.end[e]])

    def classes(self, e: int) -> set[str]:
        return set(self.attributes[e].get("class", "").split())

    def around(self, e: int) -> list[int]:
        """The elements around, innermost first, without the page itself."""
        out = []
        while self.parent[e]:
            e = self.parent[e]
            out.append(e)
        return out

    def named(self, *names: str) -> list[int]:
        """Elements with one of the names, in order."""
        return [e for e, n in enumerate(self.name) if n in names]

    def links(self) -> list[int]:
        """Anchors with an href, in order."""
        return [e for e in self.named("a") if "href" in self.attributes[e]]

    def children(self, *names: str) -> dict[int, list[int]]:
        """Element to those directly in it that have one of the names."""
        out: dict[int, list[int]] = {}
        for e in self.named(*names):
            out.setdefault(self.parent[e], []).append(e)
        return out
