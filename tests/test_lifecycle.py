"""A scope to a frozen manifest to objects and statuses, twice."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gneiss.plans import acquisition, cli
from gneiss.sources import sinks
from gneiss.sources.schemas import REGISTRY

BASE = "https://portal.example"
CATALOG = '<div><h2>Peraturan Perundang-undangan Pusat</h2><ul><li><a href="/Search?jenis=8">Undang-Undang</a> <a href="/Search?jenis=8">5</a></li></ul></div>'
PDF = bytearray(b"%PDF-1.7 some bytes %%EOF")


def result_page(ids, active, last):
    cards = "".join(f'<div class="card"><a class="card-title" href="/Details/{i}/uu">T {i}</a></div>' for i in ids)
    items = "".join(f'<li class="{"active" if n == active else ""}"><a href="/Search?p={n}">{n}</a></li>' for n in range(1, last + 1))
    return cards + f'<ul class="pagination">{items}</ul>'


def detail_page(i, links, title=True, year=2020, place="Indonesia"):
    rows = [("Bentuk", "Undang-Undang"), ("Bentuk Singkat", "UU"), ("Nomor", str(i)), ("Tahun", str(year)), ("Lokasi", place)] + ([("Judul", f"UU {i}")] if title else [])
    return "".join(f'<div class="row"><div>{k}</div><div>{v}</div></div>' for k, v in rows) + "".join(f'<a href="{u}">Unduh</a>' for u in links) + '<p>Lihat <a href="/Details/12/x">UU 12</a></p>'


DETAILS = {11: [], 12: ["/Download/12.pdf", "/Download/lost.pdf"], 13: ["/Download/page.pdf"], 14: ["/Download/12.pdf"], 15: ["/Download/12.pdf", "/Download/15.pdf"], 16: ["/Download/12.pdf"]}


def captured():
    rows = [{"url": BASE, "html": CATALOG, "group": "pusat"}]
    for n, ids in enumerate(([11, 12, 13], [14, 15, 16]), 1):
        rows.append({"url": f"s{n}", "html": result_page(ids, n, 2), "group": "pusat", "type_id": "8", "year": 2020, "page": n})
    for i, links in DETAILS.items():
        html = detail_page(i, links, title=i != 14, place="Kota Bandung" if i == 16 else "Indonesia")
        rows.append({"url": f"{BASE}/Details/{i}/uu", "html": html})
    return rows


def payloads(spark):
    pdf = lambda n: bytearray(b"%PDF-1.7 " + str(n).encode() + b" %%EOF")
    rows = [(f"{BASE}/Download/12.pdf", pdf(12), "application/pdf"), (f"{BASE}/Download/15.pdf", pdf(15), "text/html"), (f"{BASE}/Download/page.pdf", bytearray(b"<html>no</html>"), "application/pdf")]
    return spark.createDataFrame(rows, "source_url string, content binary, content_type string")


def test_lifecycle(spark, tmp_path, capsys):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.jsonl").write_text("\n".join(json.dumps(r) for r in captured()))
    files, types = str(tmp_path / "payloads"), str(tmp_path / "types")
    payloads(spark).write.parquet(files)
    spark.createDataFrame([("pusat", "8", "Undang-Undang")], "group string, type_id string, name string").write.parquet(types)
    root = f"file://{tmp_path}/archive"
    scope = ["--pages", str(pages), "--base", BASE, "--from-year", "2020", "--to-year", "2020"]
    go = lambda *argv: cli.run(spark, ["--root", root, *argv])
    assert go("plan", *scope) == 0
    assert json.loads(capsys.readouterr().out) == {"types": 1, "partitions": 1, "reported_total": 5}
    assert go("plan", *scope, "--type", "99") == 3 and go("plan", *scope, "--all") == 3
    assert go("ingest", "--run-id", "1", "--pages", str(pages), "--payloads", files, "--types", types) == 3
    assert go("discover", *scope) == 0
    archive = acquisition.Archive(spark, root)
    assert archive.read()["manifest_items"].count() == 6
    assert go("discover", *scope) == 3  # frozen
    work = ["--run-id", "1", "--pages", str(pages), "--payloads", files, "--types", types]
    assert go("ingest", *work, "--limit", "2") == 2
    states = lambda: {r.source_id: r.status for r in archive.read()["manifest_items"].collect()}
    assert sum(s == "pending" for s in states().values()) == 4
    assert go("ingest", *work) == 2
    assert states() == {"11": "no_file", "12": "partial", "13": "partial", "14": "unresolved", "15": "done", "16": "out_of_scope"}
    tables = archive.read()
    assert tables["objects"].count() == 6 + 2 and tables["objects"].where("mime_type = 'application/pdf'").count() == 2
    assert tables["instruments"].count() == 5
    counts = {n: tables[n].count() for n in REGISTRY}
    assert go("retry", *work) == 2
    again = {n: archive.read()[n].count() for n in REGISTRY}
    assert again | {"source_fetch_events": 0} == counts | {"source_fetch_events": 0} and again["source_fetch_events"] > counts["source_fetch_events"]
    capsys.readouterr()
    assert go("references") == 0
    got = json.loads(capsys.readouterr().out)
    assert got["known"] == got["total"] > 0
    assert go("status") == 0
    report = json.loads(capsys.readouterr().out)
    assert report["memberships"] == 6 and report["manifest"]["total"] == 6 and report["objects"]["pdf_unique_sha256"] == 2
    assert go("verify") == 0
    assert json.loads(capsys.readouterr().out) == {"checked": 8, "ok": 8, "missing": 0, "bad": 0}
    # one content damaged and one lost
    held = archive.stored().orderBy("sha256").collect()
    packed = spark.read.parquet(f"{root}/contents").where(F.col("sha256") != held[0].sha256)
    spoiled = packed.withColumns({"content": F.when(F.col("sha256") == held[1].sha256, F.lit(b"x")).otherwise(F.col("content")), "path": F.when(F.col("sha256") == held[1].sha256, "x").otherwise(F.col("path"))})
    spoiled.write.parquet(f"file://{tmp_path}/spoiled")
    assert go("verify", "--objects", f"file://{tmp_path}/spoiled") == 2
    assert json.loads(capsys.readouterr().out) == {"checked": 8, "ok": 6, "missing": 1, "bad": 1}


def test_broken_run_heals(spark, tmp_path):
    """A run that ends between contents and registry: nothing is lost, and the next start names what was stored."""
    archive = acquisition.Archive(spark, f"file://{tmp_path}/archive")
    texts = spark.createDataFrame([(bytearray(b"<html>a</html>"), "text/html"), (bytearray(b"b"), "text/plain")], "content binary, content_type string")
    contents = sinks.store(texts, archive.read()["objects"])
    archive.keep(contents)
    assert archive.read()["objects"].count() == 0 and archive.recover("now") == 2 and archive.recover("now") == 0
    archive.keep(contents)
    assert archive.stored().count() == 2 and acquisition.verify(archive.read(), archive.stored()).first().ok == 2


def test_one_writer(spark, tmp_path, capsys):
    root = f"file://{tmp_path}/archive"
    archive = acquisition.Archive(spark, root)
    with archive.writing():
        assert cli.run(spark, ["--root", root, "setup"]) == 3
    assert cli.run(spark, ["--root", root, "setup"]) == 0 and all(t.versions() for t in archive.tables.values())


def test_more_verbs(spark, tmp_path, capsys):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.jsonl").write_text("\n".join(json.dumps(r) for r in captured()))
    go = lambda *argv: cli.run(spark, ["--root", f"file://{tmp_path}/archive", *argv])
    assert go("catalog", "--pages", str(pages), "--base", BASE) == 0
    assert json.loads(capsys.readouterr().out)["type_id"] == "8"
    (tmp_path / "c.toml").write_text("pilot_year = 2019\noverlap_years = 1\n")
    config = ["--pages", str(pages), "--base", BASE, "--config", str(tmp_path / "c.toml"), "--current-year", "2020"]
    assert go("sync", *config) == 2  # 2019 has no captured page
    runs = acquisition.Archive(spark, f"file://{tmp_path}/archive").read()["acquisition_runs"]
    assert [(r.from_year, r.to_year) for r in runs.collect()] == [(2019, 2020)]
    assert go("backfill", *config, "--from-year", "2020") == 0


def test_listed(spark, tmp_path, capsys):
    """Listed documents need no scope; a limit keeps the first ones; the reserve stops a run before it writes."""
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "a.jsonl").write_text("\n".join(json.dumps(r) for r in captured()))
    files, types, listed = (str(tmp_path / n) for n in ("payloads", "types", "listed"))
    payloads(spark).write.parquet(files)
    spark.createDataFrame([("pusat", "8", "Undang-Undang")], "group string, type_id string, name string").write.parquet(types)
    rows = [(str(i), f"{BASE}/Details/{i}/uu", f"T {i}") for i in (15, 12, 11, 15, 16)]
    spark.createDataFrame(rows, "source_id string, detail_url string, title_hint string").write.parquet(listed)
    archive = acquisition.Archive(spark, f"file://{tmp_path}/archive")
    go = lambda *argv: cli.run(spark, ["--root", archive.folder, *argv])
    work = ["--documents", listed, "--year", "2020", "--pages", str(pages), "--payloads", files, "--types", types]
    (tmp_path / "c.toml").write_text(f"reserve_bytes = {1 << 60}\n")
    assert go("listed", *work, "--config", str(tmp_path / "c.toml")) == 3 and not archive.tables["acquisition_runs"].versions()
    assert go("listed", *work, "--limit", "2") == 2
    states = lambda n: {r.source_id: r.status for r in archive.read()["manifest_items"].where(F.col("run_id") == n).collect()}
    assert states(1) == {"11": "no_file", "12": "partial"}
    assert go("listed", *work) == 2
    assert states(2) == {"11": "no_file", "12": "partial", "15": "done", "16": "out_of_scope"}
    assert [(r.mode, r.status) for r in archive.read()["acquisition_runs"].orderBy("id").collect()] == [("backfill", "partial")] * 2
    capsys.readouterr()
    assert go("status", "--output", str(tmp_path / "report.json")) == 0
    assert json.loads((tmp_path / "report.json").read_text()) == json.loads(capsys.readouterr().out)
    bounded = ["--pages", str(pages), "--base", BASE, "--from-year", "2020", "--to-year", "2020"]
    assert go("discover", *bounded, "--max-pages", "1") == 2 and go("discover", *bounded) == 0
