"""Page parsers, the captured-page source and the incremental forms."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gneiss.operators import merge
from gneiss.sources import portal, regulations
from gneiss.streaming import incremental

BASE = "https://portal.example"
CATALOG = """<div><h2>Peraturan Perundang-undangan Pusat</h2><ul>
<li><a href="/Search?jenis=8">Undang-Undang</a> <a href="/Search?jenis=8">2.345</a></li>
<li><a href="/Search?jenis=36">Keputusan  Menteri</a> <a href="/Search?jenis=36">86</a></li>
<li><a href="/Search?jenis=300">Peraturan Daerah</a></li></ul></div><footer><a href="/About">9</a></footer>"""


def test_catalog():
    got = regulations.catalog(CATALOG, "pusat", BASE)
    assert [(t["type_id"], t["name"], t["reported_total"], t["classification"]) for t in got] == [("8", "Undang-Undang", 2345, "pusat"), ("36", "Keputusan Menteri", 86, "pusat"), ("300", "Peraturan Daerah", None, "daerah")]
    assert {t["classification"] for t in regulations.catalog(CATALOG, "lembaga", BASE)} == {"unresolved", "daerah"}


def page(ids, pager="", total=""):
    cards = "".join(f'<div class="card"><a class="card-title" href="/Details/{i}/uu-tahun-2020">T {i}</a><p>Mencabut <a href="/Details/1">x</a></p></div>' for i in ids)
    return f"{total}{cards}{pager}"


def pager(active, last, disabled=True):
    items = "".join(f'<li class="{"active" if n == active else ""}"><a href="/Search?p={n}">{n}</a></li>' for n in range(1, last + 1))
    off = '<li class="disabled"><a href="/Search?p=99">Next</a></li>' if disabled else ""
    return f'<ul class="pagination">{items}{off}</ul>'


def test_results():
    got = regulations.results(page([510007]), BASE)
    assert [d["source_id"] for d in got["documents"]] == ["510007"] and got["has_more"] is None
    for n, (following, more) in {1: (2, True), 3: (4, True), 5: (None, False)}.items():
        got = regulations.results(page([n + 10], pager(n, 5)), BASE, page_number=n)
        assert (got["next_page"], got["has_more"]) == (following, more)
    assert not regulations.results(page([1], pager(2, 5)), BASE, page_number=3)["parser_ok"]
    odd = regulations.results('<p><a href="/Details/5">x</a></p>', BASE)
    assert not odd["parser_ok"] and odd["diagnostics"] and not odd["documents"]
    assert regulations.results(page([7], total="<p>Menemukan 1 peraturan</p>"), BASE)["has_more"] is False


DETAIL = """<h1>Fallback</h1><div class="row"><div>Judul</div><div>UU Contoh</div></div><table><tr><th>Bentuk Singkat</th><td>UU</td></tr>
<tr><th>Nomor</th><td>5</td></tr><tr><th>Tahun</th><td>2026</td></tr></table><dl><dt>Lokasi</dt><dd>Indonesia</dd></dl>
<h4>Status</h4><ul><li><b>Mengubah</b> <a href="/Details/431122/x">UU 1</a></li></ul>
<a href="/Read/1.pdf">Lihat</a><a href="/Download/7/a.pdf">Unduh</a><a href="/f?id=2">Download</a><a href="/Download/7/a.pdf">lagi</a><footer><p>Tahun</p><p>1999</p></footer>"""


def test_detail(spark):
    df = spark.createDataFrame([(f"{BASE}/Details/3", DETAIL), (f"{BASE}/Details/4", "<p>nothing</p>"), ("u", None)], "url string, html string")
    got = regulations.instruments(regulations.details(df)).orderBy("url").collect()
    one = got[0]
    assert one.instrument.id == "ID:UU:2026:5" and one.title == "UU Contoh"
    assert one.file_urls == [f"{BASE}/Download/7/a.pdf", f"{BASE}/f?id=2"]
    assert [(r.target_source_id, r.context_label) for r in one.references] == [("431122", "Mengubah")]
    assert got[1].instrument is None and got[2].instrument is None


def test_filter_mismatch(spark):
    html = '<select name="tahun"><option value="2020" selected>2020</option></select>'
    df = spark.createDataFrame([(html, "8", 2020), (html, "8", 2021)], "html string, type_id string, year int")
    assert [r.diagnostics for r in regulations.filter_mismatch(df).orderBy("year").collect()] == [[], ["returned tahun is 2020"]]


def test_captured_pages(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"url": "u", "html": CATALOG, "group": "pusat"}) + "\n")
    portal.register(spark)
    pages = spark.read.format("captured_pages").load(str(tmp_path))
    assert regulations.catalog_types(pages, BASE).count() == 3


def test_discovery(spark):
    rows = [(1, "pusat", "8", 2020, 1, page([11, 12], pager(1, 2))), (1, "pusat", "8", 2020, 2, page([13], pager(2, 2))), (1, "pusat", "9", 2020, 1, page([21], pager(1, 2))), (1, "pusat", "9", 2020, 2, page([21], pager(2, 3)))]
    pages = spark.createDataFrame(rows, "run_id bigint, group string, type_id string, year int, page int, html string")
    manifest, partitions = incremental.discover(regulations.search_pages(pages, BASE))
    assert sorted(r.source_id for r in manifest.collect()) == ["11", "12", "13", "21"]
    got = {r.type_id: (r.status, r.discovered_count, r.last_error) for r in partitions.collect()}
    assert got == {"8": ("complete", 3, None), "9": ("partial", 1, "page repeats the one before")}


def test_runs(spark):
    from gneiss.sources.schemas import REGISTRY

    runs = spark.createDataFrame([], REGISTRY["acquisition_runs"])
    scope = {"groups": ["pusat"], "types": [{"type_id": "8", "reported_total": 5}], "from_year": 2020, "to_year": 2021}
    runs, one, new = incremental.start_run(runs, scope, "p", "t")
    assert new
    runs, two, new = incremental.start_run(runs, scope | {"types": [{"type_id": "8", "reported_total": 6}]}, "p", "t")
    assert two == one and not new
    _, three, new = incremental.start_run(runs, scope | {"query": "x"}, "p", "t")
    assert three != one and new


def test_stream(spark, tmp_path):
    updates = spark.createDataFrame([(k, k % 3, f"v{k}") for k in range(30)], "seq bigint, id bigint, value string")
    updates.repartition(5).write.parquet(str(tmp_path / "in"))
    table = incremental.VersionedTable(spark, f"file://{tmp_path}/table", "id bigint, value string, seen bigint")

    def policy(current, batch):
        return merge.last_wins(None, current.withColumn("seq", F.col("seen")).unionByName(batch), ["id"])

    stream = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in")).withColumn("seen", F.col("seq"))
    incremental.merge_stream(stream, table, policy, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in table.read().select("id", "value").collect()) == [(0, "v27"), (1, "v28"), (2, "v29")]
    # a batch that is run again gives the same table
    last = table.versions()[-1]
    before = sorted(map(tuple, table.read().collect()))
    table.write(last, policy(table.read(before=last), updates.withColumn("seen", F.col("seq")).where("seq >= 24")))
    assert sorted(map(tuple, table.read().collect())) == before
