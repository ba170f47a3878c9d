"""Registry queries: scans, joins, aggregates, merge policies, quality gates, discovery and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.operators import merge, pdf, profile, quality, redundancy, registry, selection
from gneiss.plans.registering import Catalogue
from gneiss.sources import readers, regulations, sinks
from gneiss.sources.workspace import scratch
from gneiss.streaming import incremental

LISTED = Catalogue()
query = LISTED.add


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 500 ORDER BY o_orderkey LIMIT 100")
def keyset_batch(t):
    """The next 100 finished orders behind a key."""
    return readers.keyset_batch(t("orders").where("o_orderstatus = 'F'"), "o_orderkey", 500, 100).select("o_orderkey", "o_custkey")


def _items(t):
    """orders as manifest items of runs (run = priority)."""
    return t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("run_id"), F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "failed").otherwise("done").alias("status"), F.year("o_orderdate").alias("year"))


_ITEMS = "(SELECT o_orderkey AS id, o_orderpriority AS run_id, CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'P' THEN 'failed' ELSE 'done' END AS status, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"
_RUN = "1-URGENT"


@query(f"SELECT id, status FROM {_ITEMS} WHERE run_id = '{_RUN}' AND status IN ('pending', 'running', 'failed', 'partial', 'unresolved', 'no_file') ORDER BY id LIMIT 200")
def retry_selection(t):
    """The first 200 items that a retry takes up."""
    return readers.open_items(_items(t), _RUN, retry=True, limit=200).select("id", "status")


@query(f"SELECT id, year FROM {_ITEMS} WHERE run_id = '{_RUN}' AND status IN ('pending', 'running') ORDER BY year, id")
def manifest_list(t):
    """Open items of a run by year and id."""
    return readers.manifest(_items(t), _RUN).select("id", "year")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'P')")
def latest_row(t):
    """The newest row that matches."""
    return readers.latest(t("orders").where("o_orderstatus = 'P'"), "o_orderkey").select("o_orderkey", "o_totalprice")


@query("SELECT run_id, coalesce(status, 'total') AS status, count(*) AS n FROM " + _ITEMS + " GROUP BY GROUPING SETS ((run_id, status), (run_id))")
def status_counts(t):
    """Items of each status and in all, by run."""
    rows = _items(t)
    counted = rows.groupBy("run_id", "status").agg(F.count("*").alias("n"))
    return counted.unionByName(rows.groupBy("run_id").agg(F.lit("total").alias("status"), F.count("*").alias("n")))


@query(f"SELECT coalesce(status, 'total') AS status, count(*) AS n FROM {_ITEMS} GROUP BY ROLLUP (status)")
def status_totals(t):
    """Items of each status and in all."""
    return registry.status_counts(_items(t))


def _members(t):
    """customers as memberships: type = segment, source = key."""
    return t("customer").select(F.lit(1).cast("bigint").alias("run_id"), F.lit("p").alias("provider"), F.col("c_nationkey").cast("string").alias("source_id"), F.lit("g").alias("group"), F.col("c_mktsegment").alias("type_id"), (F.col("c_custkey") % 4).cast("int").alias("year"))


def _records(t):
    """nations as source records; every third without an instrument."""
    return t("nation").where("n_nationkey % 7 <> 0").select(F.lit("p").alias("provider"), F.col("n_nationkey").cast("string").alias("source_id"), F.when(F.col("n_nationkey") % 3 != 0, F.col("n_regionkey").cast("string")).alias("instrument_id"))


@query("""
SELECT 'g' AS "group", c_mktsegment AS type_id, coalesce(CAST(2000 + r_regionkey AS INTEGER), CAST(nullif(c_custkey % 4, 0) AS INTEGER)) AS year, count(*) AS memberships, count(DISTINCT c_nationkey) AS documents, count(DISTINCT iid) AS instruments
FROM customer LEFT JOIN (SELECT n_nationkey, CASE WHEN n_nationkey % 3 <> 0 THEN n_regionkey END AS iid FROM nation WHERE n_nationkey % 7 <> 0) ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = iid GROUP BY ALL""")
def membership_distribution(t):
    """Memberships, documents and instruments by type and year, through two outer joins."""
    instruments = t("region").select(F.col("r_regionkey").cast("string").alias("id"), (2000 + F.col("r_regionkey")).cast("int").alias("year"))
    return registry.distribution_by_year(_members(t), _records(t), instruments)


def _references(t):
    return t("orders").select(F.lit("p").alias("provider"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("target_source_id"))


def _known(t):
    return t("customer").where("c_acctbal > 0").select(F.lit("p").alias("provider"), F.col("c_custkey").alias("source_id"))


@query("SELECT count(*) AS total, count(*) FILTER (o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) AS known, greatest(0, count(*) - count(*) FILTER (o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))) AS missing FROM orders")
def reference_coverage(t):
    """Orders whose customer is known, and the rest."""
    return registry.reference_coverage(_references(t), _known(t))


@query("SELECT o_orderkey AS id, o_custkey AS target_source_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def unresolved_targets(t):
    """Orders whose customer isn't known."""
    return registry.unresolved_targets(_references(t), _known(t)).select("id", "target_source_id")


def _files(t):
    """lineitem as files of snapshots: object = part; returned lines aren't downloaded."""
    return t("lineitem").select(F.lit("p").alias("provider"), F.col("l_orderkey").alias("source_id"), F.col("l_suppkey").alias("detail_sha256"), F.col("l_linenumber").alias("url"), F.when(F.col("l_returnflag") == "R", "failed").otherwise("downloaded").alias("status"), F.col("l_partkey").alias("sha256"))


def _stored(t):
    return t("part").select(F.col("p_partkey").alias("sha256"), F.col("p_size").cast("bigint").alias("logical_size"), (F.col("p_size") % 7).cast("bigint").alias("stored_size"))


@query("""
WITH l AS (SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'R'), u AS (SELECT * FROM part WHERE p_partkey IN (SELECT l_partkey FROM l))
SELECT a.*, b.*, file_links - pdf_unique_sha256 AS duplicate_sha256 FROM (SELECT count(*) AS file_links, CAST(sum(p_size) AS BIGINT) AS logical_bytes FROM l JOIN part ON p_partkey = l_partkey) a,
 (SELECT count(*) AS pdf_unique_sha256, CAST(sum(p_size) AS BIGINT) AS pdf_bytes, CAST(sum(p_size % 7) AS BIGINT) AS physical_bytes FROM u) b""")
def file_links_logical_physical(t):
    """Links, logical bytes over links, distinct objects and their bytes."""
    return registry.storage(_files(t), _stored(t))


@query("SELECT o_orderpriority AS run_id, count(*) AS files FROM orders JOIN lineitem ON l_orderkey = o_orderkey AND l_suppkey = o_custkey % 10 GROUP BY 1")
def files_of_run(t):
    """Files of the snapshots that the items of each run saw, by run."""
    items = t("orders").select(F.lit("p").alias("provider"), F.col("o_orderkey").alias("source_id"), (F.col("o_custkey") % 10).alias("detail_sha256"))
    found = registry.files_of_run(_files(t), items)
    return found.join(t("orders").select(F.col("o_orderkey").alias("source_id"), F.col("o_orderpriority").alias("run_id")), "source_id").groupBy("run_id").agg(F.count("*").alias("files"))


@query("SELECT l_orderkey AS source_id, l_suppkey AS detail_sha256, count(*) AS expected, count(*) FILTER (l_returnflag <> 'R') AS downloaded, count(*) = count(*) FILTER (l_returnflag <> 'R') AS complete FROM lineitem GROUP BY 1, 2")
def files_complete(t):
    """Whether all files of each snapshot are there."""
    return registry.files_complete(_files(t)).drop("provider")


@query("SELECT type_id, year, reported_total, coalesce(m, 0) AS members, coalesce(m, 0) = reported_total AS complete FROM (SELECT DISTINCT c_mktsegment AS type_id, y AS year, CAST(40 AS BIGINT) AS reported_total FROM customer, (VALUES (0), (1), (2), (3), (4)) v(y)) LEFT JOIN (SELECT c_mktsegment AS type_id, CAST(c_custkey % 4 AS INTEGER) AS year, count(*) AS m FROM customer GROUP BY 1, 2) USING (type_id, year)")
def partition_comparison(t):
    """Partitions with the number of their members, against what was reported."""
    types = t("customer").select(F.lit(1).cast("bigint").alias("run_id"), F.lit("g").alias("group"), F.col("c_mktsegment").alias("type_id")).distinct()
    partitions = registry.year_partitions(types, 0, 4).withColumn("reported_total", F.lit(40).cast("bigint"))
    return registry.partition_counts(partitions, _members(t)).select("type_id", "year", "reported_total", "members", "complete")


@query("SELECT (SELECT count(*) FROM nation) AS instruments, (SELECT count(*) FROM events) AS source_observations, (SELECT count(*) FROM customer) AS source_records, (SELECT count(*) FROM orders) AS document_references, (SELECT count(*) FROM part) AS objects, (SELECT CAST(sum(p_size) AS BIGINT) FROM part) AS logical_bytes, (SELECT CAST(sum(p_size % 7) AS BIGINT) FROM part) AS stored_bytes")
def registry_stats(t):
    """Counts and sums over five tables."""
    return registry.registry_stats({"instruments": t("nation"), "source_observations": t("events"), "source_records": t("customer"), "document_references": t("orders"), "objects": _stored(t)})


@query("""
SELECT CAST(1 AS BIGINT) AS run_id, (SELECT count(*) FROM customer) AS memberships, (SELECT count(DISTINCT c_nationkey) FROM customer) AS sources,
 (SELECT count(DISTINCT n_regionkey) FROM nation WHERE n_nationkey % 7 <> 0 AND n_nationkey % 3 <> 0 AND n_nationkey IN (SELECT c_nationkey FROM customer)) AS distinct_instruments,
 (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS documents_downloaded, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS failed,
 (SELECT count(*) FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'R')) AS unique_objects""")
def coverage_report(t):
    """The report of a run, some of its numbers."""
    spark = t("nation").sparkSession
    items = _items(t).select(F.lit(1).cast("bigint").alias("run_id"), F.lit("p").alias("provider"), F.col("id").alias("source_id"), "status")
    files = _files(t)
    items = items.join(files.select("source_id", "detail_sha256").distinct(), "source_id", "left")
    tables = {
        "acquisition_runs": spark.createDataFrame([(1, "partial", "2024-01-01")], "id bigint, status string, frozen_at string"),
        "discovery_memberships": _members(t),
        "manifest_items": items,
        "discovery_partitions": spark.createDataFrame([(1, "g", "BUILDING", 1, "complete", 3)], "run_id bigint, group string, type_id string, year int, status string, reported_total bigint"),
        "source_records": _records(t),
        "instruments": t("region").select(F.col("r_regionkey").cast("string").alias("id")),
        "document_files": files,
        "objects": _stored(t),
    }
    flags = _items(t).agg(F.count_if(F.col("status") == "done").alias("documents_downloaded"), F.count_if(F.col("status") == "failed").alias("failed"))
    report = registry.coverage(1, tables)
    return report.select("run_id", "memberships", "sources", "distinct_instruments", F.col("objects.pdf_unique_sha256").alias("unique_objects")).join(flags)


@query("SELECT count(DISTINCT (l_partkey, l_suppkey)) AS pairs, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def composite_distinct(t):
    """Exact distinct counts of a pair of keys."""
    return t("lineitem").agg(F.count_distinct("l_partkey", "l_suppkey").alias("pairs"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("SELECT n_nationkey, y AS year FROM nation, (SELECT unnest(range(2020, 2027)) AS y) WHERE n_regionkey = 1")
def year_partitions(t):
    """A partition for each type and year."""
    rows = registry.year_partitions(t("nation").where("n_regionkey = 1").select("n_nationkey"), 2020, 2026)
    return rows.select("n_nationkey", F.col("year").cast("bigint").alias("year"))


@query("SELECT count(*) AS types, count(*) * 7 AS partitions, CAST(sum(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE 0 END) AS BIGINT) AS reported_total FROM nation")
def discovery_plan(t):
    """Types, partitions and reported totals of a plan."""
    return registry.plan(t("nation").select(F.when(F.col("n_nationkey") % 2 == 0, F.col("n_nationkey")).alias("reported_total")), 2020, 2026)


@query("SELECT n_nationkey FROM nation WHERE n_regionkey = 2 AND n_nationkey IN (1, 5, 8, 12, 18)")
def scope_selection(t):
    """Types of the verified class among the requested ids."""
    types = t("nation").select("n_nationkey", F.col("n_nationkey").cast("string").alias("type_id"), F.col("n_regionkey").cast("string").alias("classification"))
    return registry.in_scope(types, "2", ["1", "5", "8", "12", "18"]).select("n_nationkey")


@query("""
SELECT o_orderkey, (o_orderkey % 3 <> 0 AND year(o_orderdate) <> 1995 + o_orderkey % 3) OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 1 AS outside FROM orders""")
def out_of_scope(t):
    """Items of another year or a regional place or form."""
    k = F.col("o_orderkey")
    requested = F.when(k % 3 == 0, 0).otherwise((1995 + k % 3).cast("int"))
    place = F.when(k % 5 == 0, "Kota Bandung").otherwise("Kotawaringin")
    form = F.when(k % 7 == 1, "Peraturan Bupati").otherwise("Undang-Undang")
    return t("orders").select("o_orderkey", registry.out_of_scope(requested, F.year("o_orderdate"), place, form).alias("outside"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN NOT (c_custkey % 5 = n % 5) ELSE NOT (n_name IN (SELECT n_name FROM nation WHERE n_nationkey % 5 = n % 5)) END AS unresolved_class FROM (SELECT c_custkey, c_nationkey AS n, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey)""")
def unresolved_classes(t):
    """Items whose observed type isn't one of their memberships."""
    customers = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    key = [F.lit(1).cast("bigint").alias("run_id"), F.lit("p").alias("provider"), F.col("c_custkey").alias("source_id")]
    observed_id = F.when(F.col("c_custkey") % 2 == 0, F.when(F.col("c_custkey") % 5 == F.col("c_nationkey") % 5, F.concat(F.lit("t"), (F.col("c_nationkey") % 5).cast("string"))).otherwise("none"))
    items = customers.select(*key, observed_id.alias("observed_type_id"), F.concat(F.lit(" "), F.lower("n_name")).alias("observed_type"))
    types = t("nation").select(F.concat(F.lit("t"), (F.col("n_nationkey") % 5).cast("string")).alias("type_id"), F.col("n_name").alias("name"))
    members = customers.select(*key, F.concat(F.lit("t"), (F.col("c_nationkey") % 5).cast("string")).alias("type_id"))
    return registry.unresolved_class(items, members, types).select(F.col("source_id").alias("c_custkey"), "unresolved_class")


def _updates(t):
    """events as updates by user, in order of arrival."""
    return t("events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"), F.col("event_type"), F.col("value"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("maybe"))


@query("SELECT user_id AS id, arg_min(event_type, event_id) AS event_type, arg_min(value, event_id) AS value FROM events GROUP BY 1")
def first_wins(t):
    """Insert-or-ignore: the first event of each user."""
    return merge.first_wins(None, _updates(t).drop("maybe"), ["id"])


@query("SELECT user_id AS id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def last_wins(t):
    """Overwrite: the last event of each user."""
    return merge.last_wins(None, _updates(t).drop("maybe"), ["id"])


@query("SELECT user_id AS id, arg_min(event_type, event_id) AS event_type, arg_max(value, event_id) AS value, arg_max(event_type, event_id) FILTER (event_id % 3 = 0) AS maybe FROM events GROUP BY 1")
def coalesce_merge(t):
    """Kept, newest and coalesced columns in one fold."""
    return merge.fold(None, _updates(t), ["id"], keep=["event_type"], newest=["value"], coalesced=["maybe"])


@query("""
SELECT user_id AS provider, event_type AS source_url, CASE WHEN event_id % 4 <> 0 THEN event_id % 3 END AS content_sha256, min(event_id) AS id FROM events WHERE event_id % 4 <> 0 GROUP BY 1, 2, 3
UNION ALL SELECT user_id, event_type, NULL, event_id FROM events WHERE event_id % 4 = 0""")
def null_distinct_dedup(t):
    """Distinct observations; those without a hash are all kept."""
    rows = t("events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("provider"), F.col("event_type").alias("source_url"), F.when(F.col("event_id") % 4 != 0, F.col("event_id") % 3).alias("content_sha256"), F.col("event_id").alias("id"))
    return merge.first_wins_null_distinct(None, rows, ["provider", "source_url", "content_sha256"], "content_sha256").select("provider", "source_url", "content_sha256", "id")


@query("SELECT user_id AS id, arg_max(event_type, event_id) AS status, count(*) AS attempts, arg_max(value, event_id) FILTER (event_id % 3 = 0) AS instrument_id FROM events WHERE user_id % 2 = 0 GROUP BY 1")
def item_transitions(t):
    """Status changes of items: attempts add up, ids are kept, the status is the newest."""
    e = t("events")
    current = e.where("user_id % 2 = 0").select(F.col("user_id").alias("id")).distinct().withColumns({"status": F.lit("pending"), "attempts": F.lit(0), "instrument_id": F.lit(None).cast("double"), "last_error": F.lit(None).cast("string"), "updated_at": F.lit(""), "detail_sha256": F.lit(None).cast("string")})
    updates = e.select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"), F.col("event_type").alias("status"), F.lit(1).alias("attempts"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("instrument_id"), F.lit(None).cast("string").alias("last_error"), F.col("ts").cast("string").alias("updated_at"), F.lit(None).cast("string").alias("detail_sha256"))
    return merge.transition_items(current, updates).select("id", "status", F.col("attempts").cast("bigint").alias("attempts"), "instrument_id")


@query("SELECT count(DISTINCT o_custkey) AS added FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def manifest_added(t):
    """How many new keys a batch brings."""
    return merge.count_added(t("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), t("orders").select(F.col("o_custkey").alias("k")), ["k"])


@query("SELECT user_id, coalesce(arg_min(event_type, event_id) FILTER (event_id % 3 = 0 ), '{}') AS metadata_json, min(event_id) AS id FROM events GROUP BY 1")
def manifest_items(t):
    """Items added once, with the first metadata that says anything."""
    rows = t("events").select(F.col("event_id").alias("seq"), F.lit(1).alias("run_id"), F.lit("p").alias("provider"), F.col("user_id").alias("source_id"), F.col("event_id").alias("id"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise("{}").alias("metadata_json"))
    return merge.add_manifest_items(None, rows).select(F.col("source_id").alias("user_id"), "metadata_json", "id")


@query("""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN 'failed' WHEN o_orderkey % 7 = 0 OR o_orderkey % 13 = 0 THEN 'out_of_scope' WHEN o_orderkey % 5 = 0 OR o_orderkey % 17 = 0 THEN 'unresolved' WHEN n = 0 THEN 'no_file' WHEN r > 0 THEN 'partial' ELSE 'done' END AS status
FROM (SELECT o_orderkey, count(l_orderkey) AS n, count(*) FILTER (l_returnflag = 'R') AS r FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)""")
def ingest_status(t):
    """Final status of each item from its outcomes."""
    files = t("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("files"), F.count_if(F.col("l_returnflag") == "R").alias("file_failures"))
    k = F.col("id")
    rows = t("orders").select(F.col("o_orderkey").alias("id")).join(files, "id", "left").na.fill(0)
    rows = rows.select("id", (k % 11 == 0).alias("failed"), (k % 7 == 0).alias("wrong_year"), (k % 13 == 0).alias("regional"), F.when(k % 5 != 0, "x").alias("instrument_id"), (k % 17 == 0).alias("unresolved_class"), "files", F.col("files").alias("expected"), (F.col("files") - F.col("file_failures")).alias("downloaded"), "file_failures")
    return merge.item_status(rows).select("id", "status")


@query(f"SELECT run_id, CASE WHEN count(*) FILTER (status IN ('pending', 'failed')) > 0 THEN 'partial' ELSE 'complete' END AS status FROM {_ITEMS} WHERE status = 'done' OR run_id <> '2-HIGH' GROUP BY 1")
def run_statuses(t):
    """Status of each run."""
    return merge.run_status(_items(t).where("status = 'done' OR run_id <> '2-HIGH'"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5)")
def pending_work(t):
    """Units that nothing has finished."""
    done = t("lineitem").where("l_linenumber = 5").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.pending(t("orders").select("o_orderkey"), done, ["o_orderkey"])


@query("""
SELECT user_id, event_type, first_seen_at, last_seen_at, row_number() OVER (PARTITION BY user_id ORDER BY last_seen_at DESC, first_seen_at DESC, event_type DESC) = 1 AS is_current
FROM (SELECT user_id, event_type, min(event_id) AS first_seen_at, max(event_id) AS last_seen_at FROM events GROUP BY 1, 2)""")
def revisions(t):
    """Versions of each key with the times they were seen."""
    rows = t("events").select(F.col("event_id").alias("seq"), "user_id", "event_type", F.col("event_id").alias("seen_at"))
    return merge.revisions(None, rows, ["user_id"], "event_type")


@query(f"SELECT run_id, count(*) FILTER (status <> 'done') = 0 AS can_freeze, count(*) AS partitions FROM {_ITEMS} GROUP BY 1")
def freeze_gate(t):
    """Whether each run may be frozen."""
    rows = _items(t).withColumn("status", F.when(F.col("status") == "done", "complete").otherwise(F.col("status")))
    return quality.can_freeze(rows)


@query("""
WITH p AS (SELECT o_custkey, o_orderkey, o_orderstatus AS s, o_orderpriority AS ids, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page FROM orders)
SELECT o_custkey, page, CASE WHEN s = 'P' THEN 'page not recognised' WHEN ids = lag(ids) OVER (PARTITION BY o_custkey ORDER BY page) THEN 'page repeats the one before' WHEN o_orderkey % 4 = 0 THEN 'end of results unknown' END AS error FROM p""")
def pagination_errors(t):
    """Fail-closed checks over result pages in order."""
    o = t("orders").withColumn("page", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("bigint"))
    pages = o.select(F.lit(1).alias("run_id"), F.lit("g").alias("group"), F.col("o_custkey").alias("type_id"), F.lit(0).alias("year"), "page", F.array("o_orderpriority").alias("ids"), (F.col("o_orderstatus") != "P").alias("parser_ok"), F.when(F.col("o_orderkey") % 4 != 0, True).alias("has_more"), F.lit(None).cast("bigint").alias("reported_total"))
    return quality.page_errors(pages).select(F.col("type_id").alias("o_custkey"), "page", "error")


@query("""
SELECT 'left' AS side, count(*) AS n FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber <= 2 EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber >= 2)
UNION ALL SELECT 'right', count(*) FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber >= 2 EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linenumber <= 2)""")
def set_difference(t):
    """Rows that only one of two sets has, by side."""
    pairs = lambda c: t("lineitem").where(c).select("l_partkey", "l_suppkey")
    return quality.difference(pairs("l_linenumber <= 2"), pairs("l_linenumber >= 2")).groupBy("side").agg(F.count("*").alias("n"))


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t):
    """Keys that occur more than once."""
    return quality.duplicate_keys(t("lineitem"), "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, CAST(sum(size) OVER (ORDER BY o_orderkey) AS BIGINT) AS running, sum(size) OVER (ORDER BY o_orderkey) <= 50000000 AS fits FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS size FROM orders)")
def storage_budget(t):
    """Running sizes against a budget."""
    rows = t("orders").select("o_orderkey", F.floor("o_totalprice").cast("bigint").alias("size"))
    return quality.within_budget(rows, "o_orderkey", "size", 50_000_000).drop("size")


@query("SELECT (SELECT CAST(sum(l_linenumber) AS BIGINT) FROM lineitem) AS left_total, (SELECT count(*) FROM orders) AS right_total, (SELECT CAST(sum(l_linenumber) AS BIGINT) FROM lineitem) - (SELECT count(*) FROM orders) AS gap, false AS agree")
def reconcile_totals(t):
    """Two totals that should agree."""
    return quality.reconcile(t("lineitem").agg(F.sum("l_linenumber").alias("total")), t("orders").agg(F.count("*").alias("total")))


@query("SELECT l_orderkey AS sha256, CASE WHEN count(*) > 1 THEN 'duplicate' WHEN o_orderkey IS NULL THEN 'unknown' ELSE 'size' END AS problem FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0) ON o_orderkey = l_orderkey WHERE l_linenumber >= 6 GROUP BY l_orderkey, o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL OR max(l_linenumber) <> 6")
def sample_problems(t):
    """Sampled rows that are repeated, unknown or of another size."""
    sample = t("lineitem").where("l_linenumber >= 6").select(F.col("l_orderkey").alias("sha256"), F.col("l_linenumber").alias("logical_size"))
    population = t("orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("sha256"), F.lit(6).alias("logical_size"))
    return quality.sample_problems(sample, population)


@query("SELECT p_partkey AS sha256, CASE WHEN l IS NULL THEN 'missing' WHEN p_partkey % 5 = 0 THEN 'bad' ELSE 'ok' END AS state FROM part LEFT JOIN (SELECT DISTINCT l_partkey AS l FROM lineitem WHERE l_linenumber = 1) ON l = p_partkey")
def object_states(t):
    """Registered objects against stored ones: ok, missing or bad."""
    key = lambda c: F.sha2(F.col(c).cast("string"), 256)
    objects = t("part").select(key("p_partkey").alias("sha256"), F.col("p_partkey").alias("id"))
    stored = t("lineitem").where("l_linenumber = 1").select(key("l_partkey").alias("sha256"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_partkey").cast("string").cast("binary")).otherwise(F.lit(b"x")).alias("content"))
    return quality.verify_objects(objects, stored).select(F.col("id").alias("sha256"), "state")


@query("SELECT l_suppkey, count(DISTINCT l_partkey) AS payloads, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1")
def ambiguous_names(t):
    """Names that stand for several payloads."""
    return redundancy.ambiguous_names(t("lineitem"), "l_suppkey", "l_partkey")


@query("SELECT l_partkey, CAST(sum(q) AS BIGINT) AS bytes, count(*) AS n, array_to_string(list_sort(list_distinct(list(l_shipmode)))[1:5], ',') AS names FROM (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS q, l_returnflag || l_linestatus || l_linenumber AS l_shipmode FROM lineitem) GROUP BY 1 ORDER BY bytes DESC, l_partkey LIMIT 10")
def top_fonts(t):
    """The ten payloads with most bytes and up to five of their names."""
    rows = t("lineitem").select("l_partkey", F.col("l_quantity").cast("bigint").alias("q"), F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("name"))
    return redundancy.top_names(rows, "l_partkey", "q", "name").withColumn("names", F.array_join("names", ","))


@query("""
SELECT l_returnflag, l_partkey, l_orderkey, l_linenumber, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_orderkey, l_linenumber) AS d FROM lineitem WHERE l_quantity <= 20) WHERE d = 1) WHERE rank <= 3""")
def first_distinct_per_codec(t):
    """The first three distinct payloads of each codec, of bounded size."""
    rows = redundancy.first_of_each(t("lineitem"), "l_returnflag", "l_partkey", "l_quantity", ["l_orderkey", "l_linenumber"], 20)
    return rows.select("l_returnflag", "l_partkey", "l_orderkey", "l_linenumber", "rank")


@query("""
WITH g AS (SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1 ORDER BY total DESC, l_suppkey LIMIT 10),
d AS (SELECT l_suppkey, total, l_partkey, max(CAST(l_quantity AS BIGINT)) AS size, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS n FROM lineitem JOIN g USING (l_suppkey) GROUP BY 1, 2, 3)
SELECT l_suppkey, total, max(l_partkey) FILTER (n = 1) AS first, max(l_partkey) FILTER (n = 2) AS second, max(size) AS largest FROM d WHERE n <= 2 GROUP BY 1, 2 HAVING max(l_partkey) FILTER (n = 2) IS NOT NULL AND max(size) <= 50""")
def largest_pairs(t):
    """The first two payloads of the largest groups."""
    rows = t("lineitem").select("l_suppkey", "l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
    return redundancy.pairs_of_largest(rows, "l_suppkey", "l_partkey", "q", most=50)


@query("""
WITH r AS (SELECT l_orderkey AS o, l_partkey AS p, count(DISTINCT l_linenumber) AS c, min(l_linenumber) AS x FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, CASE WHEN c IS NULL THEN 'missing' WHEN c = 1 THEN 'resolved' ELSE 'ambiguous' END AS state, CASE WHEN c = 1 THEN x END AS xref FROM lineitem LEFT JOIN r ON o = l_orderkey AND p = l_partkey""")
def placement_resolution(t):
    """Placements matched with the only resource that fits."""
    base = t("lineitem").select(F.col("l_orderkey").alias("file_sha256"), F.lit(1).alias("page_number"), F.col("l_partkey").alias("width"), F.lit(1).alias("height"), F.lit(8).alias("bpc"), F.col("l_linenumber").alias("xref"), "l_returnflag", "l_linenumber")
    found = pdf.resolve_placements(base.drop("xref", "l_returnflag"), base.where("l_returnflag <> 'N'"))
    return found.select(F.col("file_sha256").alias("l_orderkey"), "l_linenumber", "state", "xref")


@query("""
WITH RECURSIVE e AS (SELECT n_nationkey AS a, (n_nationkey * 7 + 3) % 25 AS b FROM nation), w AS (SELECT n_nationkey AS font, n_nationkey AS spot, [n_nationkey] AS path FROM nation WHERE n_regionkey = 0
  UNION ALL SELECT font, b, list_append(path, b) FROM w JOIN e ON a = spot WHERE NOT list_contains(path, b))
SELECT DISTINCT font, CAST(spot + 100 AS INTEGER) AS program FROM w WHERE spot % 4 = 0""")
def font_programs(t):
    """Programs that fonts reach through references."""
    n = t("nation")
    at = F.col("n_nationkey")
    steps = n.select(F.lit("f").alias("file_sha256"), at.alias("xref"), F.lit("FontDescriptor").alias("key"), ((at * 7 + 3) % 25).alias("target"))
    ends = n.where("n_nationkey % 4 = 0").select(F.lit("f").alias("file_sha256"), at.alias("xref"), F.lit("FontFile2").alias("key"), (at + 100).alias("target"))
    fonts = n.where("n_regionkey = 0").select(F.lit("f").alias("file_sha256"), at.alias("xref"))
    return pdf.font_programs(steps.unionByName(ends), fonts).select("font", "program")


@query("""
SELECT o_custkey AS file, o_orderkey AS xref, CASE WHEN o_orderstatus = 'P' THEN 'image' WHEN o_orderkey % 3 = 0 THEN 'font' WHEN o_orderstatus = 'F' THEN 'content' ELSE 'other' END AS category FROM orders""")
def object_categories(t):
    """Categories of objects by the first mark that holds."""
    o = t("orders").select(F.col("o_custkey").alias("file_sha256"), F.col("o_orderkey").alias("xref"), "o_orderstatus")
    return pdf.categorize(o, o.where("o_orderstatus = 'P'"), o.where("xref % 3 = 0"), o.where("o_orderstatus = 'F'")).select(F.col("file_sha256").alias("file"), "xref", "category")


@query("""
SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) - coalesce(s, 0) AS residual, coalesce(r, 0) AS image_bytes FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS s, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = 'R'), 0) AS BIGINT) AS r FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def file_summaries(t):
    """Bytes of files in no category."""
    files = t("orders").select(F.col("o_orderkey").alias("sha256"), F.floor("o_totalprice").cast("bigint").alias("source_bytes"))
    objects = t("lineitem").select(F.col("l_orderkey").alias("file_sha256"), F.when(F.col("l_returnflag") == "R", "image").when(F.col("l_returnflag") == "A", "font").otherwise("other").alias("category"), F.col("l_quantity").cast("bigint").alias("encoded_bytes"))
    return pdf.summarize_files(files, objects).select(F.col("sha256").alias("o_orderkey"), F.col("residual_file_bytes").alias("residual"), F.coalesce("image_bytes", F.lit(0)).alias("image_bytes"))


@query("""
SELECT c_mktsegment AS document_type, l_returnflag AS codec, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
UNION ALL SELECT o_orderpriority, l_returnflag, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT), count(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2""")
def codec_by_doctype(t):
    """Bytes by type and codec; a document of two types counts in both."""
    files = t("orders").join(t("customer"), F.col("c_custkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("sha256"), F.array(F.struct(F.col("c_mktsegment").alias("document_type")), F.struct(F.col("o_orderpriority").alias("document_type"))).alias("sources"))
    objects = t("lineitem").select(F.col("l_orderkey").alias("file_sha256"), F.array("l_returnflag").alias("filters"), F.col("l_quantity").cast("bigint").alias("encoded_bytes"))
    return pdf.codec_by_type(objects, files)


@query("SELECT l_orderkey, count(DISTINCT l_suppkey % 5) AS placed, count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS images, count(DISTINCT l_partkey) FILTER (l_returnflag = 'A') AS fonts FROM lineitem GROUP BY 1")
def resource_counts(t):
    """Distinct resources of each file."""
    objects = t("lineitem").select(F.col("l_orderkey").alias("file_sha256"), F.col("l_partkey").alias("xref"), F.when(F.col("l_returnflag") == "R", "image").when(F.col("l_returnflag") == "A", "font").otherwise("other").alias("category"))
    pages = t("lineitem").groupBy(F.col("l_orderkey").alias("sha256"), "l_linestatus").agg(F.collect_list(F.struct((F.col("l_suppkey") % 5).cast("int").alias("xref"))).alias("images"))
    return pdf.resource_counts(pages, objects).select(F.col("file_sha256").alias("l_orderkey"), F.col("image_resources").alias("placed"), F.col("image_objects").alias("images"), F.col("font_objects").alias("fonts"))


@query("SELECT count(*) AS selected, count(*) FILTER (o_orderstatus = 'F') AS ok, count(*) FILTER (o_orderstatus <> 'F') AS not_ok FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 3)")
def cohort_outcomes(t):
    """Outcomes of a chosen cohort."""
    rows = t("orders").select(F.col("o_orderkey").alias("sha256"), F.when(F.col("o_orderstatus") == "F", "ok").otherwise("failed").alias("status"))
    return pdf.cohort(rows, t("lineitem").where("l_linenumber = 3").select(F.col("l_orderkey").alias("sha256")))


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 3 = 0")
def quarantined_pages(t):
    """Pages that can't be trusted."""
    rows = t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), (F.col("o_orderstatus") != "P").alias("parser_ok"), F.when(F.col("o_orderkey") % 3 != 0, True).alias("has_more"))
    return sinks.quarantine(rows).select("id", "status")


@query("SELECT l_orderkey AS sha256 FROM lineitem WHERE l_linenumber = 1 AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def receipt_replay(t):
    """Receipts that the registry hasn't."""
    objects = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("sha256"))
    return sinks.unrecorded(t("lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("sha256")), objects)


@query("SELECT CAST(c_custkey AS DOUBLE) AS id, c_name AS name, CAST(NULL AS VARCHAR) AS extra FROM customer UNION ALL SELECT s_acctbal, s_name, '{\"k\":' || s_suppkey || '}' FROM supplier")
def unified_export(t):
    """Two tables under one schema: widened numbers, nested values as JSON."""
    a = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t("supplier").select(F.col("s_acctbal").alias("id"), F.col("s_name").alias("name"), F.struct(F.col("s_suppkey").alias("k")).alias("extra"))
    return sinks.export_parquet([a, b])


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) WHERE n = 1")
def ordered_distinct(t):
    """The first event of each user: a distinct union in order of sight."""
    return selection.first_seen(t("events"), "user_id", ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("""
WITH RECURSIVE d AS (SELECT l_returnflag AS c, l_linestatus AS g, CAST(l_orderkey AS VARCHAR) AS sha, min(l_linenumber) AS page FROM lineitem GROUP BY ALL),
k AS (SELECT c, g, shas, row_number() OVER (ORDER BY c, g) AS n, greatest(1, 24 // count(*) OVER ()) AS quota FROM (SELECT c, g, list(sha ORDER BY sha) AS shas FROM d GROUP BY c, g)),
walk AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS seen, CAST([] AS VARCHAR[]) AS took UNION ALL
  SELECT k.n, list_concat(seen, list_slice(list_filter(shas, lambda x: NOT list_contains(seen, x)), 1, quota)), list_slice(list_filter(shas, lambda x: NOT list_contains(seen, x)), 1, quota) FROM walk JOIN k ON k.n = walk.n + 1)
SELECT class_name, audit_group, sha256, page_number FROM (SELECT c AS class_name, g AS audit_group, sha AS sha256, page AS page_number, row_number() OVER (ORDER BY n, sha) AS place
  FROM (SELECT k.c, k.g, k.n, unnest(took) AS sha FROM walk JOIN k USING (n)) JOIN d USING (c, g, sha)) WHERE place <= 24""")
def audit_turns(t):
    """Pages for an audit, from groups in order, no document twice."""
    rows = t("lineitem").select(F.col("l_returnflag").alias("class_name"), F.col("l_linestatus").alias("audit_group"), F.col("l_orderkey").cast("string").alias("sha256"), F.col("l_linenumber").alias("page_number"))
    return selection.by_groups(rows, 24).drop("place")


@query()
def coverage_selection(t):
    """Pages that cover tags and strata, chosen one after the other."""
    kind = F.when(F.col("lang").isin("en", "de"), "PMK").otherwise("PP")
    rows = t("documents").select(F.col("doc_id").cast("string").alias("sha256"), F.lit(1).alias("page_number"), F.array(kind, "source", F.when(F.col("n_chars") < 500, "small").when(F.col("n_chars") < 3000, "medium").otherwise("large")).alias("stratum"), T.content_tags("text", F.lit(0.5)).alias("tags"))
    return selection.cover(rows, 24)


@query("""
WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page, count(*) OVER (PARTITION BY o_custkey) AS pages FROM orders)
SELECT o_custkey, count(*) AS discovered, 'complete' AS status, CAST(max(pages) AS INTEGER) AS last FROM p GROUP BY 1""")
def discovery(t):
    """Result pages parsed and folded into partitions: an order is a page with one card."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = t("orders").withColumn("page", F.row_number().over(w)).withColumn("pages", F.count("*").over(Window.partitionBy("o_custkey")))
    card = F.concat(F.lit('<div class="card"><a class="card-title" href="/Details/'), (F.col("o_orderkey") + 10).cast("string"), F.lit('/uu">Peraturan</a><a href="/Details/9">Mengubah</a></div>'))
    link = lambda n, active: F.concat(F.lit('<li class="' + ("active" if active else "") + '"><a href="/Search?p='), n.cast("string"), F.lit('">x</a></li>'))
    pager = F.concat(F.lit('<ul class="pagination">'), link(F.col("page"), True), F.when(F.col("page") < F.col("pages"), link(F.col("page") + 1, False)).otherwise(""), F.lit("</ul>"))
    pages = o.select(F.lit(1).cast("bigint").alias("run_id"), F.lit("g").alias("group"), F.col("o_custkey").cast("string").alias("type_id"), F.lit(2024).alias("year"), F.col("page").cast("int").alias("page"), F.concat(card, pager).alias("html"))
    manifest, partitions = incremental.discover(regulations.search_pages(pages, "https://portal.example").drop("error"))
    counted = manifest.groupBy("type_id").agg(F.count("*").alias("items"))
    last = pages.groupBy("type_id").agg(F.max("page").alias("last"))
    return partitions.join(counted, "type_id").join(last, "type_id").where("items = discovered_count").select(F.col("type_id").cast("bigint").alias("o_custkey"), F.col("discovered_count").alias("discovered"), "status", "last")


@query("SELECT p_partkey, 'ID:UU:' || (2000 + p_partkey % 25) || ':' || p_partkey AS id, p_name AS title, 'https://portal.example/Download/' || p_partkey || '.pdf' AS file FROM part")
def detail_pages(t):
    """Detail pages parsed into instruments and file links."""
    row = lambda k, v: F.concat(F.lit(f'<div class="row"><div>{k}</div><div>'), v, F.lit("</div></div>"))
    key = F.col("p_partkey").cast("string")
    html = F.concat(F.lit("<body>"), row("Judul", F.col("p_name")), row("Bentuk Singkat", F.lit("UU")), row("Nomor", key), row("Tahun", (2000 + F.col("p_partkey") % 25).cast("string")), F.lit('<a href="/Download/'), key, F.lit('.pdf">Unduh</a><a href="/Read/1.pdf">Baca</a></body>'))
    pages = t("part").select("p_partkey", F.concat(F.lit("https://portal.example/Details/"), key).alias("url"), html.alias("html"))
    found = regulations.instruments(regulations.details(pages))
    return found.select("p_partkey", F.col("instrument.id").alias("id"), F.col("instrument.title").alias("title"), F.element_at("file_urls", 1).alias("file"))


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_events(t):
    """The newest event of each user."""
    return incremental.latest_by_key(t("events"), "user_id", "ts", "event_id").select("user_id", "event_type", "event_id")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_events(t):
    """Counts and sums in hourly event-time windows (an extra)."""
    out = incremental.windowed(t("events"), "ts", "1 hour", "event_type")
    return out.withColumn("total", F.round("total", 4))


@query("""
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n FROM (
  SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (
    SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL '30 minutes' THEN 1 ELSE 0 END AS new FROM events)) GROUP BY user_id, s""")
def event_sessions(t):
    """Sessions of users, closed by 30 minutes without an event (an extra)."""
    return incremental.sessions(t("events"), "user_id", "ts", "30 minutes")


def stream_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user, kept by a stream of files through foreachBatch."""
    work = scratch(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    updates = events.select(F.col("event_id").alias("seq"), F.col("user_id").alias("id"), "event_type")
    updates.repartition(4, "seq").write.parquet(f"{work}/in")
    table = incremental.VersionedTable(spark, f"{work}/table", "id bigint, event_type string, seen bigint")
    stream = spark.readStream.schema(updates.schema).option("maxFilesPerTrigger", 2).parquet(f"{work}/in")
    stream = stream.withColumn("seen", F.col("seq"))

    def policy(current: DataFrame, batch: DataFrame) -> DataFrame:
        # files arrive in any order: the event's own number decides, and the table's rows have theirs
        rows = current.withColumn("seq", F.col("seen")).unionByName(batch)
        return merge.last_wins(None, rows, ["id"])

    incremental.merge_stream(stream, table, policy, f"{work}/checkpoint")
    return table.read().select("id", "event_type")


LISTED.queries["stream_last_wins"] = stream_last_wins
LISTED.oracles["stream_last_wins"] = "SELECT user_id AS id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1"
