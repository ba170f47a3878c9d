"""The registry's life cycle: a scope becomes a frozen manifest, a manifest becomes objects and statuses.

Network access is not part of it: result pages, detail pages and payloads come as captured tables.
Every step is a function from tables to tables; ``Archive`` keeps the tables in versioned folders.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.operators import merge, quality, registry
from gneiss.sources import readers, regulations, sinks
from gneiss.sources.schemas import OPEN, REGISTRY, RETRY
from gneiss.streaming.incremental import VersionedTable, discover, start_run


class Archive:
    """The registry's tables and the objects' contents below a folder.

    Each write of a table is a new version, so a broken run leaves the old one.  Contents are written before the
    registry names them; what a broken run left without a name is named by ``recover``.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self.spark, self.tables = spark, {n: VersionedTable(spark, f"{folder.rstrip('/')}/{n}", s) for n, s in REGISTRY.items()}

    def read(self) -> dict[str, DataFrame]:
        """All tables, empty at first."""
        return {n: t.read() for n, t in self.tables.items()}

    def write(self, changed: dict[str, DataFrame]) -> None:
        """The contents among what changed, if any, and then the next version of the changed tables."""
        if "contents" in changed:
            self.keep(changed["contents"])
        for n, df in changed.items():
            if n in self.tables:
                table = self.tables[n]
                table.write((table.versions() or [-1])[-1] + 1, df)

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _packed(self) -> DataFrame | None:
        fs, path = self._path("contents")
        return self.spark.read.parquet(f"{self.folder}/contents") if fs.exists(path) else None

    def keep(self, contents: DataFrame) -> None:
        """Add contents (as ``sinks.store`` gives them) that aren't there."""
        packed = self._packed()
        new = contents if packed is None else contents.join(packed.select("sha256"), "sha256", "left_anti")
        sinks.write_objects(new, f"{self.folder}/contents")

    def stored(self) -> DataFrame:
        """sha256 and the unpacked content of every stored object."""
        if self._packed() is None:
            return self.spark.createDataFrame([], "sha256 string, content binary")
        return readers.read_stored(self.spark, f"{self.folder}/contents").select("sha256", "content")

    def recover(self, now: str) -> int:
        """Name stored contents that the registry hasn't, as a run leaves them that ends between the two; how many."""
        packed = self._packed()
        if packed is None:
            return 0
        objects = self.tables["objects"].read()
        lost = sinks.unrecorded(packed.drop("content", "sha_prefix"), objects).dropDuplicates(["sha256"]).withColumn("first_seen_at", F.lit(now))
        count = lost.count()
        if count:
            self.write({"objects": objects.unionByName(_like(lost, "objects"))})
        return count

    def guard(self, reserve: int, more: int = 0) -> None:
        """ValueError where writing ``more`` bytes would leave less than ``reserve`` on the archive's file system; 0: no reserve."""
        fs, path = self._path("")
        fs.mkdirs(path)
        free = fs.getStatus(path).getRemaining()
        if reserve and free - more < reserve:
            raise ValueError(f"{free} bytes are free, {reserve} are to be kept")

    @contextmanager
    def writing(self):
        """One writer at a time: a file that only one can create; ValueError for the second."""
        fs, lock = self._path("lock")
        fs.mkdirs(lock.getParent())
        if not fs.createNewFile(lock):
            raise ValueError(f"another run writes here; if none does, delete {self.folder}/lock")
        try:
            yield
        finally:
            fs.delete(lock, False)


def _like(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns of a registry table, missing ones as nulls."""
    wanted = df.sparkSession.createDataFrame([], REGISTRY[name]).schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.fields])


def discover_run(tables: dict[str, DataFrame], scope: dict, types: DataFrame, pages: DataFrame, base: str, now: str, provider: str = regulations.PROVIDER, fresh: bool = False) -> tuple[int, dict[str, DataFrame]]:
    """The id of the scope's run and the tables after reading its result pages.

    ``types`` are the verified types of the scope (group, type_id, name), ``pages`` captured result pages
    (group, type_id, year, page, html).  The run is ready and frozen when all partitions are complete.
    """
    spark = types.sparkSession
    runs, number, _ = start_run(tables["acquisition_runs"], scope, provider, now, fresh)
    quality.require_open(runs.where(F.col("id") == number))
    planned = registry.year_partitions(types.select("group", "type_id"), None if scope.get("all_years") else scope.get("from_year"), scope.get("to_year"))
    planned = planned.select(F.lit(number).cast("bigint").alias("run_id"), "group", "type_id", F.col("year").cast("int").alias("year"), F.lit("pending").alias("status"), F.lit(1).alias("next_page"), F.lit(0).cast("bigint").alias("discovered_count"), F.lit(now).alias("updated_at"))
    keys = ["run_id", "group", "type_id", "year"]
    partitions = tables["discovery_partitions"].unionByName(_like(planned.join(tables["discovery_partitions"].select(*keys), keys, "left_anti"), "discovery_partitions"))
    asked = pages.join(types.select("group", "type_id"), ["group", "type_id"], "left_semi").withColumn("run_id", F.lit(number).cast("bigint"))
    parsed = regulations.search_pages(asked, base).drop("error")
    items, states = discover(parsed)
    states = states.withColumns({"updated_at": F.lit(now), "seq": F.lit(0)})
    partitions = merge.update_partitions(partitions, states.join(partitions.select(*keys), keys, "left_semi"), keys)
    known = tables["manifest_items"]
    base_id = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m"))
    fresh_items = items.join(known.select("run_id", "provider", "source_id"), ["run_id", "provider", "source_id"], "left_anti")
    numbered = fresh_items.join(F.broadcast(base_id)).withColumn("id", F.col("m") + F.abs(F.xxhash64("provider", "source_id")) % F.lit(1 << 53) + 1)
    added = numbered.withColumns({"status": F.lit("pending"), "attempts": F.lit(0), "metadata_json": F.to_json(F.struct("requested_year", "url_year_hint")), "updated_at": F.lit(now)})
    manifest = known.unionByName(_like(added, "manifest_items"))
    memberships = merge.add_memberships(tables["discovery_memberships"], items.select("run_id", "provider", "source_id", "group", "type_id", F.col("year").cast("int").alias("year")))
    seen = items.select("provider", "source_id", "detail_url", "title_hint", F.lit(now).alias("first_seen_at"), F.lit(now).alias("last_seen_at"), F.lit("{}").alias("metadata_json"), F.lit(0).alias("seq"))
    for c in ("instrument_id", "last_checked_at", "latest_detail_sha256"):
        seen = seen.withColumn(c, F.lit(None).cast("string"))
    records = merge.touch_source_records(tables["source_records"], seen)
    done = quality.can_freeze(partitions.where(F.col("run_id") == number)).select(F.col("run_id").alias("id"), "can_freeze")
    runs = runs.join(F.broadcast(done), "id", "left")
    own = F.col("id") == number
    complete = own & F.coalesce("can_freeze", F.lit(False))
    runs = runs.withColumns({"status": F.when(complete, "ready").when(own, "partial").otherwise(F.col("status")), "frozen_at": F.when(complete, F.coalesce("frozen_at", F.lit(now))).otherwise(F.col("frozen_at"))}).drop("can_freeze")
    assert spark is not None
    return number, {"acquisition_runs": _like(runs, "acquisition_runs"), "discovery_partitions": _like(partitions, "discovery_partitions"), "manifest_items": manifest, "discovery_memberships": _like(memberships, "discovery_memberships"), "source_records": _like(records, "source_records")}


def listed_run(tables: dict[str, DataFrame], documents: DataFrame, year: int, now: str, limit: int | None = None, provider: str = regulations.PROVIDER) -> tuple[int, dict[str, DataFrame]]:
    """The id of a new run over listed documents (source_id, detail_url, title_hint), and the tables with it.

    The list is the run's manifest: it is frozen at once, without partitions or memberships.  A document that is
    listed twice counts once; with a limit, the first ones by source_id stay.  The limit is a feature of trial runs.
    """
    runs = tables["acquisition_runs"]
    number = (runs.agg(F.max("id")).first()[0] or 0) + 1
    rows = documents.groupBy("source_id").agg(F.min(F.struct("detail_url", "title_hint")).alias("d")).select("source_id", "d.*")
    rows = rows.orderBy("source_id").limit(limit) if limit else rows
    known = tables["manifest_items"]
    base = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m"))
    items = rows.join(F.broadcast(base)).withColumns({"run_id": F.lit(number).cast("bigint"), "provider": F.lit(provider), "year": F.lit(year), "status": F.lit("pending"), "attempts": F.lit(0), "metadata_json": F.lit("{}"), "updated_at": F.lit(now)})
    items = items.withColumn("id", F.col("m") + F.abs(F.xxhash64("provider", "source_id")) % F.lit(1 << 53) + 1)
    run = items.sparkSession.range(1).select(F.lit(number).alias("id"), F.lit("backfill").alias("mode"), F.lit(provider).alias("provider"), F.lit(year).alias("from_year"), F.lit(year).alias("to_year"), F.lit("ready").alias("status"), F.lit("{}").alias("metadata_json"), F.lit("{}").alias("scope_json"), *[F.lit(now).alias(c) for c in ("snapshot_cutoff", "created_at", "frozen_at")])
    segment = items.agg(F.count("*").alias("discovered_count")).withColumns({"run_id": F.lit(number), "year": F.lit(year), "status": F.lit("complete"), "next_page": F.lit(1), "updated_at": F.lit(now)})
    seen = items.select("provider", "source_id", "detail_url", "title_hint", F.lit(now).alias("first_seen_at"), F.lit(now).alias("last_seen_at"), F.lit("{}").alias("metadata_json"), F.lit(0).alias("seq"))
    for c in ("instrument_id", "last_checked_at", "latest_detail_sha256"):
        seen = seen.withColumn(c, F.lit(None).cast("string"))
    return number, {
        "acquisition_runs": runs.unionByName(_like(run, "acquisition_runs")),
        "run_segments": tables["run_segments"].unionByName(_like(segment, "run_segments")),
        "manifest_items": known.unionByName(_like(items, "manifest_items")),
        "source_records": _like(merge.touch_source_records(tables["source_records"], seen), "source_records"),
    }


def ingest_run(tables: dict[str, DataFrame], run_id: int, types: DataFrame, details: DataFrame, payloads: DataFrame, now: str, retry: bool = False, limit: int | None = None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Outcomes of a run's open items, and the tables after them.

    ``details`` are captured detail pages (url, html), ``payloads`` captured files (source_url, content,
    content_type).  An item without its page fails; one outside the scope keeps its page only; one whose
    file is missing, invalid or known in another form is partial.  Objects that are stored are not
    stored again, and a second run over the same tables changes nothing.  The tables come with the contents to be
    stored, which ``Archive.write`` writes first.
    """
    items = tables["manifest_items"].where((F.col("run_id") == run_id) & F.col("status").isin(*OPEN, *(RETRY if retry else ())))
    items = items.orderBy(F.col("status") != "running", "id").limit(limit) if limit else items
    pages = details.select(F.col("url").alias("detail_url"), "html").dropDuplicates(["detail_url"])
    joined = items.select("id", "run_id", "provider", "source_id", "detail_url", F.col("year").alias("requested"), "attempts").join(pages, "detail_url", "left")
    parsed = regulations.instruments(regulations.details(joined.withColumn("url", F.col("detail_url"))))
    parsed = parsed.withColumn("detail_sha256", F.sha2("html", 256))
    m = lambda k: F.try_element_at("metadata", F.lit(k))
    scoped = parsed.withColumns({"observed_type_id": m("Jenis ID"), "observed_type": F.coalesce(m("Bentuk"), m("Bentuk Singkat"))})
    scoped = registry.unresolved_class(scoped, tables["discovery_memberships"], types)
    bound = tables["acquisition_runs"].where((F.col("id") == run_id) & (F.coalesce("scope_json", F.lit("{}")) != "{}")).limit(1).count() > 0
    scoped = scoped if bound else scoped.withColumn("unresolved_class", F.lit(False))  # a list has no scope to fit
    outside = registry.out_of_scope(F.col("requested"), T.year(m("Tahun")), m("Lokasi"), m("Bentuk"))
    scoped = scoped.withColumns({"failed": F.col("html").isNull(), "outside": F.coalesce(outside, F.lit(False)), "instrument_id": F.when(F.col("instrument").isNotNull(), F.concat_ws(":", "provider", F.lit("source"), "source_id"))})
    wanted = scoped.where("NOT failed AND NOT outside").select("id", "provider", "source_id", "detail_sha256", F.explode("file_urls").alias("url"))
    files = payloads.select(F.col("source_url").alias("url"), "content", "content_type", F.lit("application/pdf").alias("expected")).dropDuplicates(["url"])
    fetched = quality.validate(wanted.join(files, "url", "left"))
    good = F.col("valid") & F.col("content").isNotNull()
    results = fetched.withColumns({"status": F.when(good, "downloaded").otherwise("failed"), "sha256": F.when(good, F.sha2("content", 256)), "error": F.when(F.col("content").isNull(), "not captured").otherwise(F.col("reason"))})
    counts = results.groupBy("id").agg(F.count("*").alias("expected"), F.count_if(F.col("status") == "downloaded").alias("downloaded"), F.count_if(F.col("status") != "downloaded").alias("file_failures"), F.coalesce(F.sum(F.when(good, F.octet_length("content"))), F.lit(0)).cast("bigint").alias("bytes"))
    outcomes = scoped.join(counts, "id", "left").na.fill(0, ["expected", "downloaded", "file_failures", "bytes"])
    outcomes = merge.item_status(outcomes.withColumns({"wrong_year": F.col("outside"), "regional": F.lit(False), "files": F.col("expected"), "unresolved_class": F.coalesce("unresolved_class", F.lit(False))}))
    outcomes = outcomes.select("id", "run_id", "provider", "source_id", "detail_url", "status", "instrument_id", "detail_sha256", "instrument", "title", "references", "html", "expected", "downloaded", "file_failures", "bytes")

    known = tables["objects"]
    stored = outcomes.where("html IS NOT NULL").select(F.col("html").cast("binary").alias("content"), F.lit("text/html").alias("content_type")).unionByName(results.where(good).select("content", "content_type"))
    contents = sinks.store(stored, known)
    objects = contents.select("sha256", "mime_type", "logical_size", "stored_size", "compression", "path", F.lit(now).alias("first_seen_at"))
    seen = outcomes.where("html IS NOT NULL").select("instrument_id", "provider", F.col("detail_url").alias("source_url"), "source_id", F.lit(now).alias("retrieved_at"), F.col("detail_sha256").alias("content_sha256"), F.lit("text/html").alias("mime_type"), F.lit(0).alias("seq"))
    seen = seen.withColumns({"id": F.abs(F.xxhash64("source_url", "retrieved_at")), "raw_path": F.lit(None).cast("string"), "metadata_json": F.lit("{}")})
    events, compact = merge.record_observations(tables["source_fetch_events"], tables["source_observations"], seen)
    facts = outcomes.where("instrument IS NOT NULL").select(F.col("instrument_id").alias("id"), "instrument.document_type", "instrument.number", "instrument.year", F.col("instrument.title").alias("title"), "instrument.jurisdiction", "instrument.issuing_body", F.col("instrument.status").alias("status"), F.to_json(F.struct(F.col("instrument.id").alias("candidate_id"), "instrument.dates", "instrument.publication")).alias("metadata_json"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at"), F.lit(0).alias("seq"))
    edges = outcomes.where("status NOT IN ('failed', 'out_of_scope')").select("instrument_id", F.explode("references").alias("r")).select("instrument_id", "r.*", F.lit(now).alias("observed_at"), F.lit("{}").alias("metadata_json"), F.lit(0).alias("seq"))
    records = outcomes.where("html IS NOT NULL").select("provider", "source_id", "detail_url", F.col("title").alias("title_hint"), "instrument_id", F.lit(now).alias("first_seen_at"), F.lit(now).alias("last_seen_at"), F.lit(now).alias("last_checked_at"), F.col("detail_sha256").alias("latest_detail_sha256"), F.lit("{}").alias("metadata_json"), F.lit(0).alias("seq"))
    expected = merge.expect_files(tables["document_files"], wanted.drop("id").withColumn("seq", F.lit(0)))
    documents = merge.record_file_results(expected, results.select("provider", "source_id", "detail_sha256", "url", "status", "sha256", "error", F.lit("{}").alias("metadata_json"), F.lit(0).alias("seq")))
    steps = outcomes.select("id", "status", F.lit(1).alias("attempts"), "instrument_id", "detail_sha256", F.when(F.col("status") == "failed", "detail page not captured").alias("last_error"), F.lit(now).alias("updated_at"), F.lit(0).alias("seq"))
    manifest = merge.transition_items(tables["manifest_items"], steps)
    state = merge.run_status(manifest.where(F.col("run_id") == run_id)).select(F.col("run_id").alias("id"), "status")
    run_steps = state.select("id", F.lit("running").alias("status"), F.lit(now).alias("at"), F.lit(0).alias("seq")).unionByName(state.select("id", "status", F.lit(now).alias("at"), F.lit(1).alias("seq")))
    changed = {
        "contents": contents,
        "objects": known.unionByName(_like(objects, "objects")),
        "source_fetch_events": _like(events, "source_fetch_events"),
        "source_observations": _like(compact, "source_observations"),
        "instruments": _like(merge.upsert_instruments(tables["instruments"], facts), "instruments"),
        "document_references": _like(merge.insert_references(tables["document_references"], edges), "document_references"),
        "source_records": _like(merge.upsert_source_records(tables["source_records"], records), "source_records"),
        "document_files": _like(documents, "document_files"),
        "manifest_items": _like(manifest, "manifest_items"),
        "acquisition_runs": _like(merge.transition_runs(tables["acquisition_runs"], run_steps), "acquisition_runs"),
    }
    return outcomes.drop("instrument", "references", "html"), changed


def status(tables: dict[str, DataFrame], run_id: int | None = None) -> DataFrame:
    """The coverage report of a run: the newest, if none is named; without any run, the registry's counts."""
    if run_id is None:
        run_id = tables["acquisition_runs"].agg(F.max("id")).first()[0]
    return registry.registry_stats(tables) if run_id is None else registry.coverage(run_id, tables)


def verify(tables: dict[str, DataFrame], stored: DataFrame) -> DataFrame:
    """Checked, sound, missing and bad objects; ``stored`` has sha256 and the unpacked content."""
    return quality.verify_summary(quality.verify_objects(tables["objects"], stored))


def references(tables: dict[str, DataFrame]) -> DataFrame:
    """Edges in all, and those whose target is known."""
    return registry.reference_coverage(tables["document_references"], tables["source_records"])
