"""Operators on small tables with known answers; replays and row order change nothing."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from gneiss.operators import codecs, merge, pdf, profile, quality, redundancy, registry, selection, shards
from gneiss.sources import readers, sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_distribution(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)] + [(float("nan"),), (float("inf"),), (None,)], "x double")
    r = profile.distributions(df, "x").first()
    assert (r["count"], r["median"], r["p10"], r["p25"]) == (4, 2.5, pytest.approx(1.3), 1.75)
    assert r["stddev"] == pytest.approx(1.11803398875)
    empty = profile.distributions(df.limit(0), "x").first()
    assert empty["count"] == 0 and empty["median"] is None


def test_redundancy(spark):
    df = spark.createDataFrame([("a", 1, "h", 10), ("a", 2, "h", 10), ("b", 1, "h", 10), ("b", 2, None, 5)], "f string, x int, h string, n bigint")
    assert tuple(redundancy.repeated_bytes(df, "f", "h", "n").first()) == (10, 10, 20)


def test_duplicate_summary(spark):
    df = spark.createDataFrame([("font", "s", 1000, "a", 1), ("font", "s", 1000, "b", 2), ("font", "t", 7, "b", 3)], "category string, encoded_sha256 string, bytes bigint, document_sha256 string, xref int")
    r = redundancy.duplicate_summary(df).first()
    line = '{"bytes":1000,"document_sha256":"b","encoded_sha256":"s","xref":2}\n'
    assert (r["gross"], r["reference_bytes"], r["capacity"]) == (1000, len(line), 1000 - len(line))


def test_coverage(spark):
    schema = "page int, width double, height double, x0 double, y0 double, x1 double, y1 double"
    df = spark.createDataFrame([(1, 200.0, 200.0, 10.0, 10.0, 70.0, 70.0), (2, 100.0, 100.0, -5.0, -5.0, 150.0, 150.0), (3, 100.0, 100.0, 0.0, 0.0, 50.0, 50.0), (3, 100.0, 100.0, 25.0, 25.0, 75.0, 75.0), (4, 10.0, 10.0, 5.0, 5.0, 5.0, 9.0)], schema)
    assert rows(pdf.coverage(df, ["page"])) == [(1, 0.09), (2, 1.0), (3, 0.4375), (4, 0.0)]


def test_payloads(spark):
    cases = [(b"", "application/pdf", "empty_payload"), (b"<html>", "application/pdf", "missing_pdf_signature"), (b"%PDF-1.4 x", "application/pdf", "missing_pdf_eof"), (b"%PDF-1.4 x %%EOF", "application/pdf", None), (b"%PDF-1.4", "text/html", "mime_mismatch:application/pdf")]
    df = spark.createDataFrame([(i, c, None, e) for i, (c, e, _) in enumerate(cases)], "i int, content binary, content_type string, expected string")
    assert [r.reason for r in quality.validate(df).orderBy("i").collect()] == [w for *_, w in cases]


def test_merge_policies(spark):
    current = spark.createDataFrame([("a", "t0", 1, "x", None)], "id string, created_at string, year int, issuing_body string, status string")
    current = current.withColumns({c: F.lit("") for c in ("document_type", "number", "title", "jurisdiction", "metadata_json", "updated_at")})
    updates = current.withColumns({"created_at": F.lit("t9"), "year": F.lit(2), "issuing_body": F.lit(None).cast("string"), "status": F.lit("s"), "seq": F.lit(0)})
    once = merge.upsert_instruments(current, updates)
    r = once.first()
    assert (r.created_at, r.year, r.issuing_body, r.status) == ("t0", 2, "x", "s")
    again = merge.upsert_instruments(once, updates)
    assert rows(again) == rows(once)


def test_null_distinct(spark):
    df = spark.createDataFrame([(0, "p", "u", None), (1, "p", "u", None), (2, "p", "u", "h"), (3, "p", "u", "h")], "seq int, provider string, source_url string, content_sha256 string")
    assert merge.first_wins_null_distinct(None, df, ["provider", "source_url", "content_sha256"], "content_sha256").count() == 3


def test_manifest(spark):
    df = spark.createDataFrame([(0, 1, "p", "1", "{}", "a"), (1, 1, "p", "1", '{"k":1}', "b"), (2, 1, "p", "2", "{}", "c")], "seq int, run_id int, provider string, source_id string, metadata_json string, detail_url string")
    out = merge.add_manifest_items(None, df)
    assert rows(out.select("source_id", "detail_url", "metadata_json")) == [("1", "a", '{"k":1}'), ("2", "c", "{}")]
    assert merge.count_added(out, df.withColumn("source_id", F.lit("3")), ["run_id", "provider", "source_id"]).first().added == 1


def test_run_transitions(spark):
    runs = spark.createDataFrame([(1, "ready", None, None)], "id int, status string, started_at string, finished_at string")
    steps = spark.createDataFrame([(0, 1, "running", "t1"), (1, 1, "partial", "t2"), (2, 1, "running", "t3"), (3, 1, "complete", "t4")], "seq int, id int, status string, at string")
    assert rows(merge.transition_runs(runs, steps)) == [(1, "complete", "t1", "t4")]


def test_item_status(spark):
    schema = "id int, failed boolean, wrong_year boolean, regional boolean, instrument_id string, unresolved_class boolean, files int, expected int, downloaded int, file_failures int"
    cases = [(True, False, False, "i", False, 1, 1, 1, 0, "failed"), (False, True, False, None, False, 1, 1, 1, 0, "out_of_scope"), (False, False, False, None, False, 1, 1, 1, 0, "unresolved"), (False, False, False, "i", False, 0, 0, 0, 0, "no_file"), (False, False, False, "i", False, 2, 2, 1, 0, "partial"), (False, False, False, "i", False, 2, 2, 2, 0, "done")]
    df = spark.createDataFrame([(i, *c[:-1]) for i, c in enumerate(cases)], schema)
    assert [r.status for r in merge.item_status(df).orderBy("id").collect()] == [c[-1] for c in cases]


def test_shards(spark):
    df = spark.createDataFrame([(k, n) for k, n in zip("abcde", (3, 4, 5, 9, 1), strict=True)], "k string, n int")
    assert [r.shard for r in shards.greedy_shards(df, "k", "n", 8).orderBy("k").collect()] == [0, 0, 1, 2, 3]
    again = shards.greedy_shards(df.repartition(3).orderBy(F.desc("n")), "k", "n", 8)
    assert [r.shard for r in again.orderBy("k").collect()] == [0, 0, 1, 2, 3]
    ids = shards.unit_ids(again, "k", "n").orderBy("shard").first()
    assert ids.unit_id == "shard:" + hashlib.sha256(b"a:3|b:4").hexdigest()[:24]


def test_codecs(spark):
    docs = spark.createDataFrame([("a", bytearray(b"x" * 5000)), ("b", bytearray(b""))], "sha string, content binary")
    got = codecs.benchmark_documents(docs, "sha", "content")
    assert got.where("status <> 'ok' OR NOT exact").count() == 0 and got.count() == 10
    left = codecs.benchmark_documents(docs, "sha", "content", done=got.where("method = 'gzip9'"))
    assert left.count() == 8
    members = docs.withColumns({"shard": F.lit(0), "unit_id": F.lit("shard:x"), "manifest_bytes": F.lit(9).cast("bigint")})
    r = codecs.benchmark_shards(members, "sha", "content", ("zstd3", "none")).orderBy("method").collect()
    assert [x.status for x in r] == ["not_available", "ok"] and r[1].output_bytes == r[1].payload_bytes + 9


def test_rollup(spark):
    schema = "mode string, method string, unit_id string, status string, exact boolean, input_bytes bigint, output_bytes bigint, manifest_bytes bigint, encode_seconds double, decode_seconds double"
    df = spark.createDataFrame([("perdoc", "m", "1", "ok", True, 10, 9, 1, 1.0, 1.0), ("perdoc", "m", "2", "ok", True, 90, 45, 1, 1.0, 1.0), ("perdoc", "m", "3", "timeout", False, 50, None, 0, None, None)], schema)
    r = codecs.rollup(df, "mode", "method").first()
    assert (r.units, r.good, r.manifest_bytes, round(r.saving, 6), r.statuses) == (3, 2, 2, 0.46, {"ok": 2, "timeout": 1})


def test_receipts(spark):
    expected = spark.createDataFrame([("perdoc", "m", u, 5, [u]) for u in "abc"], "mode string, method string, unit_id string, input_bytes bigint, members array<string>")
    good = lambda u, n=5: ("perdoc", "m", u, "ok", True, n, 3, 3, 0, True, [u])
    schema = "mode string, method string, unit_id string, status string, exact boolean, input_bytes bigint, output_bytes bigint, payload_bytes bigint, manifest_bytes bigint, independent_access boolean, member_sha256 array<string>"
    seen = spark.createDataFrame([good("a"), good("b", 6), good("d"), good("d")], schema)
    found = {r.unit_id: r.problems for r in quality.receipt_failures(expected, seen).collect()}
    assert found == {"a": [], "b": ["mismatch"], "c": ["missing"], "d": ["duplicate", "unexpected"]}


def test_pagination(spark):
    schema = "run_id int, group string, type_id string, year int, page int, ids array<string>, parser_ok boolean, has_more boolean, reported_total bigint"
    df = spark.createDataFrame([(1, "g", "t", 0, 1, ["a"], True, True, 2), (1, "g", "t", 0, 2, ["a"], True, True, 2), (1, "g", "u", 0, 1, [], True, False, 3), (1, "g", "v", 0, 1, [], True, False, 0), (1, "g", "w", 0, 1, ["x"], True, None, 1)], schema)
    got = {(r.type_id, r.page): r.error for r in quality.page_errors(df).collect()}
    assert got == {("t", 1): None, ("t", 2): "page repeats the one before", ("u", 1): "unexpected empty page", ("v", 1): None, ("w", 1): "end of results unknown"}


def test_store(spark, tmp_path):
    html = bytearray(b"<html>" + b"x" * 500)
    df = spark.createDataFrame([(html, "text/html"), (html, "text/html"), (bytearray(b"%PDF-1"), "text/html")], "content binary, content_type string")
    known = spark.createDataFrame([], "sha256 string")
    objects = sinks.store(df, known)
    assert objects.count() == 2
    web = objects.where("mime_type = 'text/html'").first()
    assert web.compression == "gzip" and web.stored_size < web.logical_size and web.path.endswith(".html.gz")
    assert sinks.verify_written(objects).count() == 0
    sinks.write_objects(objects, str(tmp_path / "o"))
    again = sinks.store(df, spark.read.parquet(str(tmp_path / "o")))
    assert again.count() == 0
    spoiled = objects.withColumn("sha256", F.lit("0" * 64))
    assert sinks.verify_written(spoiled).count() == 2


def test_object_states(spark):
    sha = hashlib.sha256(b"x").hexdigest()
    objects = spark.createDataFrame([(sha,), ("m",), ("b",)], "sha256 string")
    stored = spark.createDataFrame([(sha, bytearray(b"x")), ("b", bytearray(b"x"))], "sha256 string, content binary")
    assert {r.sha256: r.state for r in quality.verify_objects(objects, stored).collect()} == {sha: "ok", "m": "missing", "b": "bad"}


def chosen(rows, size, targets):
    """A selection by its rule, over a plain list of (sha256, page, stratum, tags)."""
    out = []
    for target in [*targets, *[None] * size]:
        free = [r for r in sorted(rows) if (r[0], r[1]) not in {(a, b) for a, b, _ in out} and (target is None or target in r[3] or target == f"{r[2][0]}/{r[2][2]}")]
        fresh = [r for r in free if r[0] not in {a for a, _, _ in out}]
        take = fresh if fresh or target is None else free
        if take and len(out) < size:
            out.append((take[0][0], take[0][1], target))
    return sorted(out, key=str)


def test_selection(spark):
    schema = "sha256 string, page_number int, stratum array<string>, tags array<string>"
    strata = [(f"s{k}", 1, [kind, "2020", size], []) for k, (kind, size) in enumerate((a, b) for a in ("PMK", "PP") for b in ("small", "medium", "large"))]
    assert len(rows(selection.cover(spark.createDataFrame(strata, schema), 6))) == 6
    one = [("s", k, ["PP", "2020", "small"], [tag]) for k, tag in enumerate(("numbers", "article", "table_candidate"), 1)]
    assert {r[1] for r in rows(selection.cover(spark.createDataFrame(one, schema), 6))} == {1, 2, 3}
    r = random.Random(5)
    for size in (1, 4, 16, 40):
        pages = [(f"s{r.randint(0, 25):02}", k, [r.choice(["PMK", "PP", "UU"]), "2020", r.choice(["small", "medium", "large"])], r.sample(selection.TAGS, r.randint(0, 3))) for k in range(60)]
        for shown in (pages, pages[::-1]):
            got = sorted(map(tuple, selection.cover(spark.createDataFrame(shown, schema), size).collect()), key=str)
            assert got == chosen(pages, size, [*selection.TAGS, *selection.STRATA])


def test_budget_over_many_partitions(spark):
    """Running sums over several thousand rows for each range partition."""
    df = spark.range(20_000).select(F.expr("pmod(id * 7919, 20000)").alias("k"), (F.col("id") % 13).alias("size"))
    got = [r.running for r in quality.within_budget(df, "k", "size", 1000).orderBy("k").collect()]
    sizes = [r["size"] for r in df.orderBy("k").collect()]
    assert got == list(itertools.accumulate(sizes))
    r = profile.floor_stats(df, "k").first()
    assert (r["count"], r.median, r.p95, r["max"]) == (20_000, 9999, 18999, 19_999)


def test_inventory(spark, tmp_path):
    path = tmp_path / "i.json"
    path.write_text('{"files": [{"path": "/a", "sha256": "BB", "size": 5}, {"path": "/b", "sha256": "aa", "logical_size": 7, "size": 1}]}')
    df = readers.inventory(spark, str(path))
    assert rows(df.select("sha256", "logical_size")) == [("aa", 7), ("bb", 5)]
    _, one = readers.identify_inventory(df, 2)
    _, two = readers.identify_inventory(df.withColumn("path", F.lit("elsewhere")).repartition(3))
    assert one == two
    with pytest.raises(ValueError):
        readers.identify_inventory(df, 3)
    with pytest.raises(ValueError):
        readers.identify_inventory(df.unionAll(df))


def test_jsonl(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"a": 1}\n{"a": 2}\n{"a": ')
    assert rows(readers.jsonl(spark, str(path), "a int")) == [(1,), (2,)]
    path.write_text('{"a": 1}\n{"a": \n{"a": 3}\n')
    with pytest.raises(Exception, match="can.t be read"):
        readers.jsonl(spark, str(path), "a int").collect()


def test_config(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('root = "r"\n[http]\ntimeout_seconds = 0\nrequest_delay_seconds = -2\nother = 1\n')
    c = readers.load_config(str(path))
    assert (c.root, c.timeout_seconds, c.request_delay_seconds, c.extra) == ("r", 1.0, 0.0, {"other": 1})


def test_limits(spark):
    items = spark.createDataFrame([(k, 1, s) for k, s in enumerate(["running", "done", "pending", "failed", "pending"])], "id int, run_id int, status string")
    assert [r.id for r in readers.open_items(items, 1, limit=2).collect()] == [0, 2]
    assert [r.id for r in readers.open_items(items, 1, retry=True, limit=0).collect()] == [0, 2, 3, 4]
    with pytest.raises(ValueError):
        readers.open_items(items, 1, limit=-1)


def test_isolate(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0)], "k string, n int")
    got = pdf.isolate(df, lambda r: {"inverse": 1 / r["n"]}, "inverse double", "k")
    assert [(r.k, r.status, r.inverse) for r in got.orderBy("k").collect()] == [("a", "ok", 1.0), ("b", "failed", None)]


def test_fonts(spark):
    refs = spark.createDataFrame([("f", 1, "DescendantFonts", 2), ("f", 2, "FontDescriptor", 3), ("f", 3, "FontFile2", 9), ("f", 5, "FontDescriptor", 6), ("f", 6, "FontDescriptor", 5)], "file_sha256 string, xref int, key string, target int")
    fonts = spark.createDataFrame([("f", 1), ("f", 5)], "file_sha256 string, xref int")
    assert rows(pdf.font_programs(refs, fonts)) == [("f", 1, 9)]


def test_health(spark):
    schema = "sha256 string, status string, encrypted boolean, repaired boolean, warnings array<string>, metadata map<string,string>, xref_unresolved int, residual_file_bytes bigint, profile_seconds double, error string"
    df = spark.createDataFrame([("a", "failed", None, None, None, None, None, None, 1.0, "boom")], schema)
    r = profile.health(df).first()
    assert (r.profiled, r.successful, r.failed) == (1, 0, 1) and profile.failed_files(df).first().error == "boom"


def test_unknown_ids(spark):
    types = spark.createDataFrame([("8",), ("36",)], "type_id string")
    assert rows(registry.unknown_ids(spark, ["8", "99"], types)) == [("99",)]


def test_fidelity(spark):
    files = spark.createDataFrame([("a", 5, [("t", "u")])], "sha256 string, page_count int, sources array<struct<title:string,detail_url:string>>")
    sample = spark.createDataFrame([("a", ["UU", "small"])], "sha256 string, stratum array<string>")
    pages = spark.createDataFrame([("a", n, "born", 0.0, 45) for n in range(1, 6)], "sha256 string, page_number int, class_name string, image_coverage double, text_chars int")
    texts = spark.createDataFrame([("a", 1, "Pasal 1", "Pasal 1"), ("a", 3, "b a", "a b")], "sha256 string, page_number int, text string, sorted_text string")
    got = pdf.fidelity_sample(sample, files, pages, texts).orderBy("page_number").collect()
    assert [(r.page_number, r.sort_changes_sequence, r.tags) for r in got] == [(1, False, ["article", "numbers"]), (3, True, []), (5, False, [])]


def test_usage(spark):
    images = spark.createDataFrame([([1], True, "resolved"), ([], False, "ambiguous")], "page_numbers array<int>, fullscan boolean, usage string")
    trials = spark.createDataFrame([(True,), (False,)], "exact boolean")
    assert tuple(pdf.usage_counts(images, trials).first()) == (2, 1, 1, 1, 2, 1)


def test_savings(spark):
    df = spark.createDataFrame([("m", "ok", True, 100, 60), ("m", "ok", True, 100, 40), ("m", "error", False, 100, None)], "method string, status string, exact boolean, input_bytes bigint, output_bytes bigint")
    r = codecs.saving_distribution(df, "method").first()
    assert (r["count"], round(r["median"], 6)) == (2, 0.5)
