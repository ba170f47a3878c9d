"""Queries of parsers, page and object structure, checks and round trips through files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.functions import values as V
from gneiss.operators import codecs, merge, pdf, profile, quality, registry
from gneiss.plans import acquisition
from gneiss.plans.registering import Catalogue
from gneiss.sources import pdf_files, readers, regulations, sinks
from gneiss.sources.schemas import REGISTRY
from gneiss.sources.workspace import scratch
from gneiss.streaming import incremental

LISTED = Catalogue()
query = LISTED.add
BASE = "https://portal.example"


@query("""
WITH q AS (SELECT l_orderkey AS page, CAST(l_partkey % 80 AS DOUBLE) AS x0, CAST(l_suppkey * 7 % 80 AS DOUBLE) AS y0, l_quantity AS d FROM lineitem),
r AS (SELECT page, x0 AS l, least(x0 + d, 100) AS r, y0 AS t, least(y0 + d, 100) AS b FROM q),
e AS (SELECT page, l AS a FROM r UNION SELECT page, r FROM r),
s AS (SELECT page, a, lead(a) OVER (PARTITION BY page ORDER BY a) AS z FROM e),
i AS (SELECT s.page, a, z, t, b FROM s JOIN r ON r.page = s.page AND l <= a AND r >= z),
w AS (SELECT *, max(b) OVER (PARTITION BY page, a ORDER BY t, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM i)
SELECT page, round(least(1.0, sum(greatest(0, b - greatest(t, coalesce(reach, t))) * (z - a)) / 10000), 8) AS coverage FROM w GROUP BY page""")
def image_coverage(t):
    """Union area of rectangles on pages."""
    left, top = (F.col("l_partkey") % 80).cast("double"), (F.col("l_suppkey") * 7 % 80).cast("double")
    rects = t("lineitem").select(F.col("l_orderkey").alias("page"), F.lit(100.0).alias("width"), F.lit(100.0).alias("height"), left.alias("x0"), top.alias("y0"), (left + F.col("l_quantity")).alias("x1"), (top + F.col("l_quantity")).alias("y1"))
    return pdf.coverage(rects, ["page"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def exists_lookup(t):
    """Orders that have a returned line."""
    return registry.exists_keys(t("orders").select("o_orderkey"), t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("""
SELECT count(*) AS processed, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS partial, count(*) FILTER (o_orderstatus = 'O') AS failed, CAST(0 AS BIGINT) AS unresolved,
  CAST(sum(o_orderkey % 4) AS BIGINT) AS expected, CAST(sum(o_orderkey % 3) AS BIGINT) AS downloaded, CAST(sum(CASE WHEN o_custkey % 2 = 0 THEN o_custkey END) AS BIGINT) AS bytes FROM orders""")
def run_counters(t):
    """Counters over the outcomes of items."""
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "partial").otherwise("failed")
    zero = F.lit(0)
    rows = t("orders").select(status.alias("status"), (F.col("o_orderkey") % 4).alias("expected"), (F.col("o_orderkey") % 3).alias("downloaded"), zero.alias("file_failures"), zero.alias("new_objects"), zero.alias("duplicate_objects"), F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("bytes"))
    return registry.run_summary(rows).select("processed", "done", "partial", "failed", "unresolved", "expected", "downloaded", "bytes")


@query("""
SELECT CASE WHEN doc_id % 5 = 0 THEN 'missing' WHEN doc_id % 5 = 1 THEN 'size' ELSE 'sha256' END AS failure, count(*) AS n FROM documents WHERE text IS NOT NULL AND doc_id % 5 < 3 AND (doc_id % 5 < 2 OR text <> '') GROUP BY 1""")
def source_revalidation(t):
    """Manifest files that are gone, or whose size or hash has changed."""
    docs = t("documents").where("text IS NOT NULL").select(F.col("doc_id"), F.col("doc_id").cast("string").alias("path"), F.col("text").cast("binary").alias("content"))
    manifest = docs.select("path", F.octet_length("content").cast("bigint").alias("logical_size"), F.sha2("content", 256).alias("sha256"))
    kind = F.col("doc_id") % 5
    flipped = F.concat(F.lit(bytearray([1])), F.expr("substring(content, 2)"))
    content = F.when(kind == 1, F.concat("content", F.lit(bytearray(b"x")))).when((kind == 2) & (F.octet_length("content") > 0), flipped).otherwise(F.col("content"))
    stored = docs.where(kind != 0).select("path", content.alias("content"))
    return quality.revalidate(manifest, stored).groupBy("failure").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS units, count(*) FILTER (o_orderkey % 7 = 0) AS failing, count(*) FILTER (o_orderkey % 7 = 0) = 0 AS full_coverage FROM orders")
def full_coverage(t):
    """Units with problems, and whether there are none."""
    rows = t("orders").select(F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit("missing"))).otherwise(F.array().cast("array<string>")).alias("problems"))
    return quality.full_coverage(rows)


@query("SELECT o_orderstatus, CAST(o_orderstatus = 'F' AS BOOLEAN) AS equal FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O'))")
def equal_tables(t):
    """Whether two tables hold the same rows, repeats counted: finished orders twice, and open ones less one key."""
    keys = lambda s: t("orders").where(F.col("o_orderstatus") == s).select("o_orderkey")
    least = keys("O").agg(F.min("o_orderkey").alias("o_orderkey"))
    both = quality.equal_sets(keys("F"), keys("F").orderBy(F.desc("o_orderkey"))).select(F.lit("F").alias("o_orderstatus"), "equal")
    less = quality.equal_sets(keys("O"), keys("O").exceptAll(least)).select(F.lit("O").alias("o_orderstatus"), "equal")
    return both.unionByName(less)


@query("""
WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, count(*) OVER (PARTITION BY o_custkey) AS pages FROM orders)
SELECT o_custkey AS run_id, CASE WHEN pages % 2 = 0 THEN 'complete' ELSE 'discovering' END AS status, CAST(CASE WHEN pages % 2 = 0 THEN pages ELSE pages + 1 END AS INTEGER) AS next_page, CAST(pages - CASE WHEN pages % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS discovered FROM p GROUP BY o_custkey, pages""")
def year_segments(t):
    """Segments that end at the first empty page: of customers with an even number of orders the last page is empty."""
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey")
    o = t("orders").withColumn("page", F.row_number().over(w.orderBy("o_orderkey"))).withColumn("pages", F.count("*").over(w))
    last = (F.col("pages") % 2 == 0) & (F.col("page") == F.col("pages"))
    one = F.array(F.struct(F.col("o_orderkey").cast("string").alias("source_id")))
    pages = o.select(F.col("o_custkey").alias("run_id"), F.lit(2020).alias("year"), "page", F.lit(True).alias("parser_ok"), F.when(last, F.filter(one, lambda _: F.lit(False))).otherwise(one).alias("documents"))
    return incremental.legacy_segments(pages).select("run_id", "status", F.col("next_page").cast("int").alias("next_page"), F.col("discovered_count").alias("discovered"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def json_columns(t):
    """The JSON properties of events as columns."""
    return readers.json_rows(t("events").select("event_id", "props"), "props", "k string")


@query("""
SELECT l_orderkey AS sha256, CAST(l_linenumber AS INTEGER) AS page_number, CASE WHEN l_returnflag = 'N' THEN 'unfiltered' WHEN l_returnflag = 'A' THEN 'FlateDecode+DCTDecode' ELSE 'DCTDecode' END AS chain,
  CASE WHEN l_returnflag = 'N' THEN 'unfiltered' ELSE 'DCTDecode' END AS codec, CAST(l_suppkey % 9 AS INTEGER) AS xref FROM lineitem WHERE l_linestatus = 'O'""")
def page_image_details(t):
    """Images of pages, one by one, with their filter chains."""
    image = F.struct((F.col("l_suppkey") % 9).cast("int").alias("xref"), F.when(F.col("l_returnflag") == "N", F.array().cast("array<string>")).when(F.col("l_returnflag") == "A", F.array(F.lit("FlateDecode"), F.lit("DCTDecode"))).otherwise(F.array(F.lit("DCTDecode"))).alias("filters"))
    images = F.when(F.col("l_linestatus") == "O", F.array(image)).otherwise(F.filter(F.array(image), lambda _: F.lit(False)))
    pages = t("lineitem").select(F.col("l_orderkey").alias("sha256"), F.col("l_linenumber").cast("int").alias("page_number"), images.alias("images"))
    return pdf.image_details(pdf.page_images(pages)).select("sha256", "page_number", "chain", "codec", "xref")


@query("""
SELECT chain, chain LIKE '%DCTDecode%' AS jpeg, CAST(sum(l_quantity) AS BIGINT) AS bytes, count(*) AS n
FROM (SELECT CASE l_returnflag WHEN 'R' THEN 'FlateDecode+DCTDecode' WHEN 'A' THEN 'FlateDecode' ELSE 'unfiltered' END AS chain, l_quantity FROM lineitem) GROUP BY 1""")
def codec_families(t):
    """Bytes by filter chain, and whether a JPEG filter is in it."""
    filters = F.when(F.col("l_returnflag") == "R", F.array(F.lit("FlateDecode"), F.lit("DCTDecode"))).when(F.col("l_returnflag") == "A", F.array(F.lit("FlateDecode"))).otherwise(F.array().cast("array<string>"))
    return pdf.codec_family(t("lineitem").select(filters.alias("filters"), F.col("l_quantity").cast("bigint").alias("encoded_bytes")))


@query("""
SELECT p_partkey, 'Type,Font,Size' || p_size AS names, p_partkey || ',' || (p_size + 1) AS refs, '1.' || (p_size % 8) AS version FROM part""")
def pdf_syntax(t):
    """Names, references and versions in object dictionaries and headers."""
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    body = F.concat(F.lit("<< /Type /Font /Size"), size, F.lit(" "), key, F.lit(" 0 R "), (F.col("p_size") + 1).cast("string"), F.lit("  3 R 7 0 obj >>"))
    head = F.concat(F.lit("%PDF-1."), (F.col("p_size") % 8).cast("string"), F.lit("\n%x"))
    return t("part").select("p_partkey", F.array_join(T.pdf_names(body), ",").alias("names"), F.array_join(T.pdf_references(body).cast("array<string>"), ",").alias("refs"), T.pdf_version(head).alias("version"))


@query("SELECT p_partkey, least(power(2.0, p_size), 20.0) AS seconds FROM part")
def backoff(t):
    """Waits that double up to a limit."""
    return t("part").select("p_partkey", T.backoff_seconds("p_size").alias("seconds"))


@query("SELECT n_nationkey, 'n' || n_nationkey AS a, CASE WHEN n_nationkey % 2 = 0 THEN 'later' ELSE 'first' END AS b, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS c, CAST(CASE WHEN n_nationkey % 2 = 0 THEN 3 ELSE 2 END AS INTEGER) AS keys FROM nation")
def metadata_merge(t):
    """Two maps as one, later entries win."""
    one = F.create_map(F.lit("a"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.lit("b"), F.lit("first"))
    two = F.when(F.col("n_nationkey") % 2 == 0, F.create_map(F.lit("b"), F.lit("later"), F.lit("c"), F.col("n_name")))
    both = t("nation").select("n_nationkey", V.merge_maps(one, two).alias("m"))
    at = lambda k: F.try_element_at("m", F.lit(k)).alias(k)
    return both.select("n_nationkey", at("a"), at("b"), at("c"), F.size("m").alias("keys"))


@query("""
SELECT count(*) AS profiled, count(*) FILTER (o_orderstatus = 'F') AS successful, count(*) FILTER (o_orderstatus <> 'F') AS failed, count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 2 = 0) AS encrypted,
  count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 3 = 0) AS repaired, count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 5 = 0) AS with_warnings, CAST(0 AS BIGINT) AS with_metadata,
  CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_custkey % 4 END), 0) AS BIGINT) AS unresolved_slots, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN o_custkey END), 0) AS BIGINT) AS residual_bytes, CAST(sum(o_orderkey % 10) AS DOUBLE) AS seconds FROM orders""")
def corpus_health(t):
    """Counters of a corpus profile."""
    key, none = F.col("o_orderkey"), F.array().cast("array<string>")
    files = t("orders").select(key.cast("string").alias("sha256"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), (key % 2 == 0).alias("encrypted"), (key % 3 == 0).alias("repaired"), F.when(key % 5 == 0, F.array(F.lit("w"))).otherwise(none).alias("warnings"), F.create_map().cast("map<string,string>").alias("metadata"), (F.col("o_custkey") % 4).alias("xref_unresolved"), F.col("o_custkey").alias("residual_file_bytes"), (key % 10).cast("double").alias("profile_seconds"), F.lit("boom").alias("error"))
    return profile.health(files)


@query("SELECT o_orderkey AS sha256, 'boom' AS error FROM orders WHERE o_orderstatus <> 'F'")
def failed_files(t):
    """Files that failed, as a table."""
    return profile.failed_files(t("orders").select(F.col("o_orderkey").alias("sha256"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"), F.lit("boom").alias("error")))


@query("""
SELECT l_orderkey AS source_url, l_returnflag AS context_label, CAST(min_by(l_linenumber, l_linenumber) AS INTEGER) AS seen FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END AS l_returnflag FROM lineitem) GROUP BY ALL""")
def reference_edges(t):
    """Edges that are inserted once; a missing label is the empty text."""
    label = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    rows = t("lineitem").select(F.lit("p").alias("provider"), F.col("l_orderkey").alias("source_url"), F.lit("u").alias("target_url"), label.alias("context_label"), F.lit(None).cast("string").alias("raw_context"), F.col("l_linenumber").cast("int").alias("seen"), F.col("l_linenumber").alias("seq"))
    found = merge.insert_references(None, rows)
    return found.select("source_url", "context_label", "seen")


@query("""
SELECT o_orderkey AS source_id, CASE o_orderstatus WHEN 'F' THEN 'downloaded' WHEN 'O' THEN 'failed' ELSE 'expected' END AS status, CASE WHEN o_orderstatus = 'F' THEN 'h' || o_custkey END AS sha256 FROM orders WHERE o_orderkey % 3 < 2""")
def file_results(t):
    """Results of expected files; results of files that nobody expects change nothing."""
    key = [F.lit("p").alias("provider"), F.col("o_orderkey").alias("source_id"), F.lit("d").alias("detail_sha256"), F.lit("u").alias("url")]
    expected = merge.expect_files(None, t("orders").where("o_orderkey % 3 < 2").select(*key, F.lit(0).alias("seq")))
    again = merge.expect_files(expected, t("orders").where("o_orderkey % 3 = 0").select(*key, F.lit(1).alias("seq")))
    done = F.col("o_orderstatus") == "F"
    results = t("orders").where("o_orderstatus <> 'P'").select(*key, F.when(done, "downloaded").otherwise("failed").alias("status"), F.when(done, F.concat(F.lit("h"), F.col("o_custkey").cast("string"))).alias("sha256"), F.lit(None).cast("string").alias("error"), F.lit("{}").alias("metadata_json"), F.lit(2).alias("seq"))
    return merge.record_file_results(again, results).select("source_id", "status", "sha256")


@query("""
SELECT n_nationkey AS run_id, CASE WHEN n_nationkey % 2 = 0 THEN 'complete' ELSE 'pending' END AS status, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 9 ELSE 1 END AS INTEGER) AS next_page, CASE WHEN n_nationkey % 2 = 0 OR n_nationkey % 3 = 0 THEN 'b' ELSE 'a' END AS updated_at FROM nation""")
def partition_updates(t):
    """Values that an update gives overwrite, others stay."""
    now = t("nation").select(F.col("n_nationkey").alias("run_id"), F.lit("pending").alias("status"), F.lit(1).alias("next_page"), F.lit("a").alias("updated_at"))
    key = F.col("n_nationkey")
    given = t("nation").where((key % 2 == 0) | (key % 3 == 0)).select(key.alias("run_id"), F.when(key % 2 == 0, "complete").alias("status"), F.when(key % 3 == 0, 9).alias("next_page"), F.lit("b").alias("updated_at"), F.lit(1).alias("seq"))
    return merge.update_partitions(now, given, ["run_id"])


@query("SELECT count(*) AS images, count(*) FILTER (l_quantity > 10) AS placed, count(*) FILTER (l_returnflag = 'R') AS fullscan, count(*) FILTER (l_linestatus = 'F') AS ambiguous, (SELECT count(*) FROM orders) AS trials, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS exact_trials FROM lineitem")
def image_usage(t):
    """Images by their use, and the streams that were tried."""
    pages = F.when(F.col("l_quantity") > 10, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    images = t("lineitem").select(pages.alias("page_numbers"), (F.col("l_returnflag") == "R").alias("fullscan"), F.when(F.col("l_linestatus") == "F", "ambiguous").otherwise("used").alias("usage"))
    return pdf.usage_counts(images, t("orders").select((F.col("o_orderstatus") == "F").alias("exact")))


@query("SELECT max(o_orderkey) AS id FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey % 10 = 3 AND o_orderstatus IN ('O', 'P')")
def resumable_run(t):
    """The newest run of a scope that can go on."""
    status = F.when(F.col("o_orderstatus") == "F", "complete").when(F.col("o_orderstatus") == "P", "partial").otherwise("ready")
    runs = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("provider"), (F.col("o_custkey") % 10).cast("string").alias("scope_fingerprint"), status.alias("status"))
    return registry.resumable_run(runs, "1-URGENT", "3").select("id")


@query("""
SELECT 'daerah' AS "group", CAST(n_nationkey AS VARCHAR) AS type_id, CASE WHEN n_nationkey % 4 = 0 THEN 'Peraturan Daerah ' ELSE '' END || n_name AS name, CASE WHEN n_nationkey % 3 <> 0 THEN CAST(n_nationkey * 1001 AS BIGINT) END AS reported_total,
  CASE WHEN n_nationkey % 4 = 0 OR n_regionkey % 2 = 0 THEN 'daerah' ELSE 'unresolved' END AS classification FROM nation""")
def catalog_pages(t):
    """Types of generated catalog pages, a page for each region; every other page is of another group than asked for."""
    key = F.col("n_nationkey").cast("string")
    link = lambda text: F.concat(F.lit('<a href="/Search?jenis='), key, F.lit('">'), text, F.lit("</a>"))
    name = F.concat(F.when(F.col("n_nationkey") % 4 == 0, "Peraturan  Daerah ").otherwise(""), F.col("n_name"))
    count = F.when(F.col("n_nationkey") % 3 != 0, link(F.regexp_replace(F.format_number(F.col("n_nationkey") * 1001, 0), ",", "."))).otherwise("")
    items = t("nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("<li>"), link(name), F.lit(" "), count, link(name), F.lit("</li>")))), "").alias("items"))
    heading = F.when(F.col("n_regionkey") % 2 == 0, "Peraturan Daerah").otherwise("Peraturan Perundang-undangan Pusat")
    pages = items.select(F.lit("daerah").alias("group"), F.concat(F.lit("<nav><a href='/Search?jenis=999'>menu</a></nav><div><h2>"), heading, F.lit("</h2><ul>"), "items", F.lit("</ul></div><footer><a href='/Search?jenis=998'>x</a></footer>")).alias("html"))
    return regulations.catalog_types(pages, BASE).select("group", "type_id", "name", "reported_total", "classification")


@query("""
SELECT o_orderkey, CAST(o_custkey + 1000000 AS VARCHAR) AS target_source_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Mengubah' ELSE 'Status' END AS context_label, 'UU ' || o_custkey AS target_label FROM orders""")
def reference_pages(t):
    """References of generated detail pages, with labels of their own or of the heading before."""
    link = F.concat(F.lit('<a href="/Details/'), (F.col("o_custkey") + 1000000).cast("string"), F.lit('/x">UU '), F.col("o_custkey").cast("string"), F.lit("</a>"))
    item = F.concat(F.lit("<ul><li>"), F.when(F.col("o_orderkey") % 2 == 0, "<b>Mengubah</b> ").otherwise(""), link, F.lit("</li></ul>"))
    # a page's own number begins with 0, as no target's does: equal keys don't make a reference a link to the page itself
    own = F.concat(F.lit("0"), F.col("o_orderkey").cast("string"))
    itself = F.concat(F.lit('<p><a href="/Details/'), own, F.lit('/a">self</a></p>'))
    pages = t("orders").select("o_orderkey", F.concat(F.lit(BASE + "/Details/"), own).alias("url"), F.concat(F.lit("<h4>Status</h4>"), item, itself).alias("html"))
    return regulations.details(pages).select("o_orderkey", F.explode("references").alias("r")).select("o_orderkey", "r.target_source_id", "r.context_label", "r.target_label")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'returned tahun is ' || (year(o_orderdate) + 1) ELSE '' END AS problem FROM orders")
def returned_filters(t):
    """Pages whose selected year isn't the one that was asked for."""
    year = F.year("o_orderdate")
    shown = F.when(F.col("o_orderkey") % 5 == 0, year + 1).otherwise(year).cast("string")
    html = F.concat(F.lit('<form><select name="tahun"><option value="1900">x</option><option value="'), shown, F.lit('" selected>x</option></select></form>'))
    pages = t("orders").select("o_orderkey", html.alias("html"), F.lit("8").alias("type_id"), year.alias("year"))
    return regulations.filter_mismatch(pages).select("o_orderkey", F.array_join("diagnostics", ";").alias("problem"))


@query("SELECT count(*) AS objects, CAST(0 AS BIGINT) AS wrong FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)")
def object_readback(t):
    """Every distinct text, stored by hash and read back from the files."""
    docs = t("documents").where("text IS NOT NULL")
    folder = scratch(docs.sparkSession)
    payloads = docs.select(F.col("text").cast("binary").alias("content"), F.lit("text/plain").alias("content_type"))
    sinks.write_objects(sinks.store(payloads, docs.select(F.lit("").alias("sha256")).where("false")), folder)
    back = readers.read_stored(docs.sparkSession, folder)
    return back.agg(F.count("*").alias("objects"), F.count_if(F.col("error").isNotNull() | (F.sha2("content", 256) != F.col("sha256"))).alias("wrong"))


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def jsonl_readback(t):
    """A table as canonical JSON lines, read back as a checkpoint."""
    nation = t("nation")
    folder = scratch(nation.sparkSession)
    sinks.write_jsonl(nation, folder)
    return readers.jsonl(nation.sparkSession, folder, "n_nationkey int, n_name string, n_regionkey int").select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT s_suppkey, s_name, '[\"' || s_name || '\",\"a,b\"]' AS tags FROM supplier")
def csv_readback(t):
    """A table as CSV, nested columns as JSON, read back with its schema."""
    rows = t("supplier").select("s_suppkey", "s_name", F.array("s_name", F.lit("a,b")).alias("tags"))
    folder = scratch(rows.sparkSession)
    sinks.write_csv(rows, folder)
    return readers.csv(rows.sparkSession, folder, "s_suppkey bigint, s_name string, tags string")


@query("SELECT * FROM (VALUES (2026, 2026, 1, 2026, 2026), (2027, 2026, 1, 2026, 2027), (2030, 2026, 1, 2029, 2030), (2030, 2020, 4, 2026, 2030)) v(now, pilot, overlap, from_year, to_year)")
def sync_window(t):
    """Years that an incremental run observes again."""
    spark: SparkSession = t("region").sparkSession
    rows = [(now, pilot, overlap, *(incremental.sync_scope(readers.Config(pilot_year=pilot, overlap_years=overlap), now)[k] for k in ("from_year", "to_year"))) for now, pilot, overlap in ((2026, 2026, 1), (2027, 2026, 1), (2030, 2026, 1), (2030, 2020, 4))]
    return spark.createDataFrame(rows, "now int, pilot int, overlap int, from_year int, to_year int")


@query("""
SELECT r_regionkey, sha256('{"all_years":true,"groups":["' || r_name || '","x"],"types":[{"type_id":"1"},{"type_id":"2"}]}') AS mark FROM region""")
def scope_marks(t):
    """Identities of scopes: the order of lists and what was reported change nothing (a row for each of a few regions)."""
    spark: SparkSession = t("region").sparkSession
    rows = [(r.r_regionkey, V.scope_fingerprint({"types": [{"type_id": "2", "reported_total": r.r_regionkey}, {"type_id": "1"}], "groups": ["x", r.r_name], "all_years": True})) for r in t("region").collect()]
    return spark.createDataFrame(rows, "r_regionkey int, mark string")


@query("""
WITH q AS (SELECT *, 2 * length(regexp_replace(p_name, '\\s', '', 'g')) AS n, round(least(1.0, p_size * 4 / CAST(200 AS DOUBLE)), 8) AS c FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN p_partkey % 3 > 0 THEN CASE WHEN c >= 0.7 AND n >= 20 THEN 'raster_text' WHEN n >= 20 AND c < 0.05 THEN 'born' WHEN c >= 0.7 THEN 'raster' WHEN n >= 20 THEN 'mixed' ELSE 'unknown' END END AS class_name,
  CASE WHEN p_partkey % 3 > 0 THEN c END AS image_coverage, CASE WHEN p_partkey % 3 > 0 THEN n END AS text_chars, CASE WHEN p_partkey % 3 > 0 THEN CAST(p_size AS BIGINT) END AS image_bytes, CASE WHEN p_partkey % 3 > 0 THEN CAST(6 AS BIGINT) END AS objects FROM q""")
def pdf_scan(t):
    """Pages and objects of generated PDF files; every third file has no header and fails."""
    body = F.format_string(
        "%s 1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj 2 0 obj << /Type /Pages /Kids [3 0 R] /MediaBox [0 0 200 100] >> endobj "
        "3 0 obj << /Type /Page /Contents 4 0 R /Resources << /XObject << /I 5 0 R >> >> >> endobj "
        "4 0 obj << /Length 6 0 R >> stream\nBT (%s) Tj T* (%s) Tj ET q %d 0 0 100 0 0 cm /I Do Q\nendstream endobj 6 0 obj 7 endobj "
        "5 0 obj << /Subtype /Image /Width 1 /Height 1 /Length %d >> stream\n%s\nendstream endobj trailer << /Root 1 0 R >>",
        F.when(F.col("p_partkey") % 3 == 0, "nothing").otherwise("%PDF-1.4"), "p_name", "p_name", F.col("p_size") * 4, "p_size", F.expr("repeat('x', p_size)"),
    )
    files = t("part").select(F.col("p_partkey").cast("string").alias("sha256"), F.encode(body, "UTF-8").alias("content"))
    found = pdf_files.tables(pdf_files.scan(files), files)
    objects = found["objects"].groupBy(F.col("file_sha256").alias("sha256")).agg(F.count("*").alias("objects"))
    rows = found["files"].join(found["pages"].select("sha256", "class_name", "image_coverage", "text_chars"), "sha256", "left").join(objects, "sha256", "left")
    return rows.select(F.col("sha256").cast("bigint").alias("p_partkey"), "status", "class_name", "image_coverage", F.col("text_chars").cast("bigint").alias("text_chars"), "image_bytes", "objects")


@query("SELECT 'doc:' || n_nationkey AS unit_id, 'ok' AS status, true AS exact, CAST(strlen(n_name) AS BIGINT) AS input_bytes FROM nation")
def limited_trials(t):
    """Trials in processes of their own, within limits of time and memory."""
    rows = codecs.benchmark_documents(t("nation"), "n_nationkey", "n_name", ("gzip9",), seconds=120.0, rss_bytes=1 << 31)
    return rows.select("unit_id", "status", "exact", "input_bytes")


@query("SELECT CAST(1 AS BIGINT) AS run_id, CAST(s_suppkey AS VARCHAR) AS source_id, '/Details/' || s_suppkey AS detail_url, s_name AS title_hint, CAST(2020 AS INTEGER) AS year, 'pending' AS status FROM supplier")
def listed_manifest(t):
    """The manifest of a run over listed documents, each of which is listed twice."""
    rows = t("supplier").select(F.col("s_suppkey").cast("string").alias("source_id"), F.concat(F.lit("/Details/"), F.col("s_suppkey").cast("string")).alias("detail_url"), F.col("s_name").alias("title_hint"))
    twice = rows.unionByName(rows.withColumn("title_hint", F.concat("title_hint", F.lit(" again"))))
    empty = {n: rows.sparkSession.createDataFrame([], s) for n, s in REGISTRY.items()}
    _, changed = acquisition.listed_run(empty, twice, 2020, "2024-01-01T00:00:00+00:00")
    return changed["manifest_items"].select("run_id", "source_id", "detail_url", "title_hint", "year", "status")
