"""HTML extraction, language identification, quality rules and toxicity."""

from __future__ import annotations

import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gneiss.llm import html, langid, quality, toxicity

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href=/a>A</a></li></ul></nav><!-- ad -->
<div class="ad">Buy now, it is cheap. Really, it is.</div><article><h1>Title</h1><p><b>First  line, with &amp; a comma.<br><p>Second&#233; line; more.</p><p>Be.</p></article>
<section id="comments"><p>A long comment, with points. And more, too.</p></section><form><p>Name, please.</p></form><footer>&copy; x</footer>"""


def test_page():
    assert html.main_text(PAGE) == "Title\nFirst line, with & a comma.\nSecondé line; more.\nBe."


def test_without_article():
    page = '<body><div class="top-menu"><a href=1>One</a><a href=2>Two</a></div><div id="main"><h2>Head</h2><p>Some text, that is long enough. It goes on, and on.</p><p>More text, also long enough; with points.</p></div><div class="sidebar"><p>Aside, aside.</p></div><div class="cookie-notice">We use cookies, yes.</div></body>'
    assert html.main_text(page) == "Head\nSome text, that is long enough. It goes on, and on.\nMore text, also long enough; with points."


LONG = "A long sentence, with points; and some more of them. " * 20


@pytest.mark.parametrize("inner", ["div", "section", "ul"])
@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_blocks_around_the_inner_part(inner, outer):
    part = f"<li>{LONG}</li>" * 3 if inner == "ul" else f"<p>{LONG}</p>" * 3
    link = "<a href=x>A link, long enough; to be more than half of the paragraph.</a>" if outer != "div" else ""
    page = f"<body><{outer}><h1>Head, of it.</h1><p>A lead, that is short; but a part. {LONG[:200]}</p><{inner}>{part}</{inner}><p>At last, a close; the end. {link}</p></{outer}></body>"
    got = html.main_text(page).split("\n")
    assert len(got) == 6 and got[0] == "Head, of it." and got[1].startswith("A lead") and got[-1].startswith("At last")


def test_references_inside_an_article():
    page = f"<body><article><p>{LONG}</p><ol><li><a href=1>Reference one</a></li></ol></article><div>Else</div></body>"
    assert html.main_text(page).split("\n")[1:] == ["Reference one"]


@pytest.mark.parametrize("mark", ['class="has-sidebar"', 'class="no-comments"', 'id="search-result"', 'style="overflow:hidden"', 'title="a hidden thing"', 'class="widget"', "hidden"])
def test_marks_around_the_page(mark):
    assert html.main_text(f"<body><div {mark}><h1>Head, of it.</h1><p>{LONG}</p><p>{LONG}</p></div></body>") == "\n".join(["Head, of it.", LONG.strip(), LONG.strip()])


def test_marks_inside_an_article():
    body = f"<p>{LONG}</p><section id=related-work><p>Related, but part.</p></section><div class='disclaimer-history'><p>Past, but part.</p></div>"
    got = html.main_text(f"<body><article>{body}<div class='share sidebar'><p>Share, please.</p></div><p hidden>Not seen, ever.</p></article><div class=comments><p>{LONG * 5}</p></div></body>")
    assert got.split("\n")[1:] == ["Related, but part.", "Past, but part."]


@pytest.mark.parametrize("mark", ["site-content has-sidebar", "col no-sidebar", "entry related-content", "search-results", "post-comments-open", "search-algorithms", "share-price-analysis"])
@pytest.mark.parametrize("outer", ["div", "article", "main"])
def test_mark_words_on_containers(mark, outer):
    page = f'<body><div class="menu"><a href=1>One</a></div><{outer} class="{mark}"><h1>Head, of it.</h1><div class="{mark}"><p>{LONG}</p><p>Short, at last.</p></div></{outer}><div class="ad">Buy, now.</div></body>'
    assert html.main_text(page) == "\n".join(["Head, of it.", LONG.strip(), "Short, at last."])


def test_marked_prose_is_weighed():
    """The thresholds decide: the same marked element is content where its text is rich, and none where it is poor."""
    page = "<body><article><h1>Head</h1><p>A few words, here.</p><div class=related><p>{}</p></div></article></body>"
    assert html.main_text(page.format("More, here.")) == "Head\nA few words, here."
    assert html.main_text(page.format(LONG)) == "Head\nA few words, here.\n" + LONG.strip()


def test_empty_article():
    assert html.main_text("<body><div class=ad>Buy now, it is cheap.</div><article></article><footer>x</footer></body>") == ""


def naive_paths(found, weight):
    """The paths' scores by their definition, block by block."""
    chosen = {}
    n = len(found)
    ratio = lambda k, b: sum((len(x.text) - x.linked, sum(c in ".,;:!?…，。、！？；：«»" for c in x.text))[k] for x in found if x.path == b.path) / sum(x.path == b.path for x in found)
    kernel = {d: 2.718281828459045 ** (-d * d / 2) for d in range(-html.RADIUS, html.RADIUS + 1)}

    def smooth(k, i):
        near = [(w, ratio(k, found[i + d])) for d, w in kernel.items() if 0 <= i + d < n]
        return min(sum(w * x for w, x in near) / sum(w for w, _ in near), 2 * ratio(k, found[i]))

    fused = [smooth(0, i) * (smooth(1, i) + 0.1) * weight[i] for i in range(n)]
    deviation = (sum((x - sum(fused) / n) ** 2 for x in fused) / n) ** 0.5
    for p in {b.path for b in found}:
        own = [x for x, b in zip(fused, found, strict=True) if b.path == p]
        chosen[p] = sum(own) / len(own)
    best = max(chosen.values())
    return {p for p, x in chosen.items() if x >= min(best, max(html.DEVIATIONS * deviation, html.SHARE * best)) * (1 - 1e-12)}


def test_thresholds_decide(data, monkeypatch):
    """Paths as by their definition; without the thresholds adverts get into the text of every generated page that has one."""
    import pyarrow.parquet as pq

    pages = [x for x in pq.read_table(f"{data}/pages.parquet").column("html").to_pylist() if x]
    for page in (html.read(x) for x in [*pages[:20], PAGE]):
        weight = [1.0 + b.element % 3 for b in page.blocks]
        assert html.content_paths(page.blocks, weight) == naive_paths(page.blocks, weight)
    texts = [html.main_text(x) for x in pages]
    monkeypatch.setattr(html, "content_paths", lambda found, weight: {b.path for b in found})
    other = [html.main_text(x) for x in pages]
    assert sum(a != b for a, b in zip(texts, other, strict=True)) > 0.9 * sum('class="ad"' in x for x in pages) > 0


def test_odd_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p></p>") == ""
    assert html.main_text("a < b & c") == "a < b & c"


def test_linear_time():
    began = time.time()
    for page in ("<div " * 20000, '<a "' * 20000, "<!--" * 20000, "<script>" * 20000, "<div>" * 20000 + "x", "<p>" + "x " * 200000, "</div>" * 20000, "<td>" * 5000):
        html.main_text(page)
    assert time.time() - began < 30


def test_pages(spark, data):
    df = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (2, None, None, "t")], "page_id long, url string, html string, text string")
    got = html.extract(df).orderBy("page_id").collect()
    assert [r.n_chars for r in got] == [len(html.main_text(PAGE))] * 2 + [0] and got[2].text == ""
    assert html.extract(df.limit(0)).count() == 0
    pages = spark.read.parquet(f"{data}/pages.parquet")
    found = html.extract(pages).join(pages.select("page_id", "html"), "page_id").toPandas()
    for r in found.itertuples():  # the generated articles hold nothing but blocks
        body = r.html[r.html.index("<article>") : r.html.index("</article>")]
        assert len(r.text) > 0 and r.n_chars == len(r.text) and body.count("<p>") + 1 >= r.text.count("\n")


def test_languages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 20 and (got.lang == got.lang_pred).mean() >= 0.95


def test_mixtures(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.learn(docs.select("text", "lang"))
    long = {lang: " ".join(r.text for r in docs.where(F.col("lang") == lang).limit(5).collect())[:3000] for lang in ("en", "de", "fr")}
    df = spark.createDataFrame([(1, long["en"]), (2, long["en"] + " " + long["de"]), (3, None), (4, "12 34 !"), (5, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(df.withColumn("score", F.lit("kept?")).drop("score"), model).collect()}
    assert got[1].lang_pred == "en" and set(got[1].shares) == {"en"}
    assert set(got[2].shares) == {"en", "de"} and all(0.3 < s < 0.7 for s in got[2].shares.values())
    assert [got[k].lang_pred for k in (3, 4, 5)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())


def test_letters_of_any_script(spark, data):
    """und exactly where no letter is."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.learn(docs.select("text", "lang"))
    with_letters = ["a", "x", "A 1 B", "é", "日", "1 ж 2", "ª", "a" * 5]
    without = ["。。。。", "——— …", "123", "_", "\u0661\u0662", "\u20ac", " \n"]
    names, score, _ = langid.infer(pa.array([*with_letters, *without]), model)
    assert all(n in model.languages for n in names[: len(with_letters)]) and names[len(with_letters) :] == ["und"] * len(without)
    assert (score[len(with_letters) :] == 0).all() and ((score >= 0) & (score <= 1)).all()


def test_mixture_against_its_definition(spark, data):
    """One text's chosen set and proportions, by plain loops over its trigrams."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = langid.learn(docs.select("text", "lang"))
    long = {lang: " ".join(r.text for r in docs.where(F.col("lang") == lang).limit(3).collect())[:600] for lang in ("en", "de", "es")}
    for text in (long["en"], long["en"] + " " + long["de"], long["en"] + " " + long["de"] + " " + long["es"], "a b", "Ein Satz"):
        _, cell = langid.trigrams(pa.array([text]))
        cells, count = np.unique(cell, return_counts=True)
        weight = count * langid.WEIGHT

        def em(languages, share, rounds):
            for _ in range(rounds):
                held = dict.fromkeys(languages, 0.0)
                for c, w in zip(cells, weight, strict=True):
                    parts = {k: model.table[c, k] * share[k] for k in languages}
                    for k in languages:
                        held[k] += w * parts[k] / sum(parts.values())
                share = {k: x / weight.sum() for k, x in held.items()}
            return share, sum(w * np.log(sum(model.table[c, k] * share[k] for k in languages)) for c, w in zip(cells, weight, strict=True))

        every = list(range(len(model.languages)))
        full, _ = em(every, dict.fromkeys(every, 1 / len(every)), langid.ROUNDS)
        single = {k: sum(w * np.log(model.table[c, k]) for c, w in zip(cells, weight, strict=True)) for k in every}
        best = max(every, key=lambda k: (single[k], -k))
        chosen, value = {best: 1.0}, single[best]
        order = sorted(every, key=lambda k: (-full[k], k))
        for n in range(2, len(every) + 1):
            begin = {k: max(full[k], 1e-3) for k in order[:n]}
            share, likelihood = em(order[:n], {k: x / sum(begin.values()) for k, x in begin.items()}, langid.ROUNDS // 2)
            worth = likelihood - langid.PENALTY * (n - 1) * np.log(weight.sum() + 1)
            if worth <= value:
                break
            chosen, value = share, worth
        _, _, shares = langid.infer(pa.array([text]), model)
        assert np.allclose(shares[0], [chosen.get(k, 0) for k in every], atol=1e-9)


def test_no_languages(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in langid.identify_documents(df).collect()] == ["und"]
    assert langid.identify_documents(df.limit(0)).count() == 0


WORDS = "".join(f"w{k} x{k}, y{k}. " for k in range(30))


def test_quality(spark):
    rows = [
        (1, None), (2, ""), (3, WORDS), (4, WORDS + "\n" + "MENU | HOME | ABOUT | SHOP"), (5, "A! " * 3 + WORDS.upper().replace(".", "!!")), (6, "same same same " * 40),
        (7, WORDS.replace("w", "*** w").replace("x", "%%% x")), (8, (WORDS + "\n") * 2), (9, "a b c\n" * 30), (10, "\t\n \x0b"), (3, WORDS),
    ]
    df = spark.createDataFrame([(i, t, False) for i, t in rows], "doc_id long, text string, kept boolean").drop("kept")
    judged = quality.judge(df)
    got = {r.doc_id: r for r in judged.collect()}
    assert {i for i, r in got.items() if r.kept} == {3, 4}
    assert got[4].clean_text == WORDS.rstrip(" ") + " " or got[4].clean_text == WORDS
    assert got[8].n_dup_lines == 1 and got[8].n_repeat_words == got[8].n_words and got[8].base_failed
    assert judged.count() == len(rows) and judged.where("kept").count() == 3
    cleaned = quality.clean(df.withColumn("n_chars", F.lit(0)))
    assert cleaned.columns == ["doc_id", "text", "n_chars"] and {r.n_chars == len(r.text) for r in cleaned.collect()} == {True}
    assert quality.judge(df.limit(0)).count() == 0


def test_quality_oracle(spark, data):
    from gneiss.llm.queries import QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data}/documents.parquet'")
    found = con.execute(quality.ORACLE)
    names = [d[0] for d in found.description]
    want = sorted(found.fetchall())
    assert sorted(tuple(r[c] for c in names) for r in QUERIES["op7_line_cleaning"](spark, data).collect()) == want


def test_quality_is_native(spark, data):
    plan = quality.judge(spark.read.parquet(f"{data}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_labels(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").select("kept", "quality").toPandas()
    assert ((got.kept == (got.quality == 1)).mean()) >= 0.97


def test_grammar():
    m = toxicity.Matcher({"idiot": 4.0, "stup*": 3.0})
    f = lambda t: dict(zip(toxicity.FEATURES, m.features(t), strict=True))
    plain, aimed, told, none = f("an idiot"), f("you idiot"), f("someone said an idiot"), f("not an idiot")
    assert aimed["score"] > plain["score"] > told["score"] > none["score"] > 0
    assert f("idiots are idiotic")["score"] == 0 and f("stupidly done")["score"] > 0
    assert f("i will kill you")["threats"] == 1 and f("kill the lights")["threats"] == 0
    assert f("no. an idiot")["score"] == plain["score"]  # another clause
    assert f("") == dict.fromkeys(toxicity.FEATURES, 0.0)


def name(k):
    """A word of its own for each number, of letters only."""
    return "q" + "".join("abcdefghij"[int(d)] for d in str(k))


def test_toxicity(spark):
    docs, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        text = f"some words {name(k)} and {name(k % 50)} here. " + (f"the {name(k)} moron {name(k + 7)}, a {name(k + 9)} trash {name(k)}. " if bad else f"the {name(k)} table. ") + f"more {name(k)}."
        docs.append((k, text))
        labels.append((k, int(bad)))
    docs += [(900, None), (901, ""), (901, "")]
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.score_documents(d.withColumn("toxic", F.lit(0)), lab).toPandas()
    held = got[got.held_out & (got.doc_id < 900)]
    assert len(held) > 40 and (held.predicted == (held.doc_id % 4 == 0)).all()
    assert len(got) == 403 and (got[got.doc_id >= 900].predicted == 0).all() and got.score.between(0, 1).all()
    blank = toxicity.score_documents(d, lab.limit(0)).toPandas()
    assert len(blank) == 403 and (blank.predicted == 0).all()


@pytest.mark.parametrize("seen", [True, False])
def test_no_copies_in_lexicon(spark, seen):
    """Words of one copied toxic text don't become insults; words in many surroundings do."""
    rows = [(f"plain text number {name(k)}", 0) for k in range(100)]
    rows += [(f"rare {'x' if not seen else name(k)} vexing {'y' if not seen else name(k + 1)}", 1) for k in range(60)]
    model = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
    assert ("vexing" in model.lexicon) == seen


def plain_clause(words, lexicon):
    """Score, aimed insults, threats, softened words and insults of a clause by the distances of its words."""
    kind = lambda w: "insult" if w in lexicon else next((n for n, own in (("target", toxicity.TARGETS), ("modal", toxicity.MODALS), ("threat", toxicity.THREATS), ("negation", toxicity.NEGATIONS), ("report", toxicity.REPORTS)) if w in own), "other")
    kinds = [kind(w) for w in words]
    last = lambda name, k: next((k - j for j in range(k - 1, -1, -1) if kinds[j] == name), 10**6)
    score, aimed, threats, soft, hits = 0.0, 0, 0, 0, 0
    open_ = intent = 0  # words that a deed still waits for its target; whether an intent came last
    for k, own in enumerate(kinds):
        weight = lexicon.get(words[k], 0.0)
        if own == "insult":
            score, hits = score + weight, hits + 1
            if last("target", k) <= 4:
                score, aimed = score + 0.5 * weight, aimed + 1
        if own == "target" and last("insult", k) <= 3 and last("target", k) > last("insult", k):
            score, aimed = score + 0.5 * lexicon[words[k - last("insult", k)]], aimed + 1
        if own == "modal":
            intent, open_ = 1, 0
        elif own == "threat":
            done = intent or open_
            score += 1.5 * bool(done)
            intent, open_ = 0, 3 if done else 1
        elif own == "target" and open_:
            score, threats, open_ = score + 1.5, threats + 1, 0
        elif open_:
            open_ -= 1
        if own in ("insult", "threat"):
            held = weight if own == "insult" else next((lexicon[words[j]] for j in range(k - 1, -1, -1) if kinds[j] == "insult"), 0.0)
            if last("negation", k) <= 4:
                score, soft = score - 0.6 * held, soft + 1
            if "report" in kinds[:k]:
                score, soft = score - 0.3 * held, soft + 1
    return max(0.0, score), aimed, threats, soft, hits


def test_clauses_against_plain_distances():
    """Random clauses: the composed machine gives what the distances between words say."""
    import random

    r = random.Random(8)
    lexicon = {"moron": 4.0, "trash": 2.5}
    m = toxicity.Matcher(lexicon)
    words = ["moron", "trash", "kill", "hurt", "will", "you", "them", "not", "said", "table", "green", "of"]
    for _ in range(5000):
        clause = r.choices(words, k=r.randrange(1, 14))
        got, wanted = m._read(" ".join(clause)), plain_clause(clause, lexicon)
        assert abs(got[0] - wanted[0]) < 1e-9 and got[1:] == wanted[1:], clause
