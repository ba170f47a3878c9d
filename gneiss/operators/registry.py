"""Joins and aggregates over registry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.functions import text as T


def status_counts(items: DataFrame, status: str = "status") -> DataFrame:
    """Rows of each status, and of all as total."""
    return items.rollup(status).agg(F.count("*").alias("n"), F.grouping(status).alias("__g")).select(F.when(F.col("__g") == 1, "total").otherwise(F.col(status)).alias("status"), "n")


def distribution_by_year(memberships: DataFrame, records: DataFrame, instruments: DataFrame) -> DataFrame:
    """Memberships, documents and instruments by group, type and the instrument's (or the partition's) year."""
    joined = memberships.join(records.select("provider", "source_id", "instrument_id"), ["provider", "source_id"], "left")
    joined = joined.join(instruments.select(F.col("id").alias("instrument_id"), F.col("year").alias("instrument_year")), "instrument_id", "left")
    year = F.coalesce("instrument_year", F.nullif("year", F.lit(0)))
    return joined.groupBy("group", "type_id", year.alias("year")).agg(F.count("*").alias("memberships"), F.count_distinct("provider", "source_id").alias("documents"), F.count_distinct("instrument_id").alias("instruments"))


def reference_coverage(references: DataFrame, records: DataFrame) -> DataFrame:
    """One row: references, those whose target is a known record, and the rest."""
    known = references.join(records.select("provider", F.col("source_id").alias("target_source_id")), ["provider", "target_source_id"], "left_semi")
    counts = references.agg(F.count("*").alias("total")).join(known.agg(F.count("*").alias("known")))
    return counts.select("total", "known", F.greatest(F.col("total") - F.col("known"), F.lit(0).cast("bigint")).alias("missing"))


def unresolved_targets(references: DataFrame, records: DataFrame) -> DataFrame:
    """References whose target no record has."""
    return references.join(records.select("provider", F.col("source_id").alias("target_source_id")), ["provider", "target_source_id"], "left_anti")


def files_of_run(files: DataFrame, items: DataFrame) -> DataFrame:
    """Files of the detail snapshots that a run's items saw."""
    return files.join(items.select("provider", "source_id", "detail_sha256"), ["provider", "source_id", "detail_sha256"], "left_semi")


def downloaded_objects(objects: DataFrame, files: DataFrame) -> DataFrame:
    """Distinct objects that a downloaded file names."""
    return objects.join(files.where("status = 'downloaded'").select("sha256"), "sha256", "left_semi")


def storage(files: DataFrame, objects: DataFrame) -> DataFrame:
    """One row: file links, logical bytes over links, distinct objects, their logical and stored bytes, repeated links."""
    links = files.where("status = 'downloaded' AND sha256 IS NOT NULL").select("sha256")
    linked = links.join(objects.select("sha256", "logical_size"), "sha256").agg(F.count("*").alias("file_links"), F.coalesce(F.sum("logical_size"), F.lit(0)).cast("bigint").alias("logical_bytes"))
    unique = downloaded_objects(objects, files).agg(F.count("*").alias("pdf_unique_sha256"), F.coalesce(F.sum("logical_size"), F.lit(0)).cast("bigint").alias("pdf_bytes"), F.coalesce(F.sum("stored_size"), F.lit(0)).cast("bigint").alias("physical_bytes"))
    return linked.join(unique).withColumn("duplicate_sha256", F.col("file_links") - F.col("pdf_unique_sha256"))


def partition_counts(partitions: DataFrame, memberships: DataFrame) -> DataFrame:
    """Partitions with the number of their memberships, zero where there is none, and whether it is what was reported."""
    keys = ["run_id", "group", "type_id", "year"]
    found = memberships.groupBy(*keys).agg(F.count("*").alias("members"))
    return partitions.join(found, keys, "left").withColumn("members", F.coalesce("members", F.lit(0))).withColumn("complete", F.col("members") == F.col("reported_total"))


def files_complete(files: DataFrame) -> DataFrame:
    """Expected and downloaded files of each detail snapshot, and whether all are there."""
    return files.groupBy("provider", "source_id", "detail_sha256").agg(F.count("*").alias("expected"), F.count_if(F.col("status") == "downloaded").alias("downloaded")).withColumn("complete", (F.col("expected") > 0) & (F.col("expected") == F.col("downloaded")))


def registry_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of counts and sums over instruments, source_observations, source_records, document_references and objects."""
    out = tables["instruments"].agg(F.count("*").alias("instruments"))
    for name in ("source_observations", "source_records", "document_references"):
        out = out.join(tables[name].agg(F.count("*").alias(name)))
    objects = tables["objects"].agg(F.count("*").alias("objects"), F.coalesce(F.sum("logical_size"), F.lit(0)).cast("bigint").alias("logical_bytes"), F.coalesce(F.sum("stored_size"), F.lit(0)).cast("bigint").alias("stored_bytes"))
    return out.join(objects)


def coverage(run_id, tables: dict[str, DataFrame]) -> DataFrame:
    """The report of one run as one row of nested structs.

    Each part is an aggregate of a few numbers or of one row a group, status or partition; the parts are
    joined as single rows.
    """
    own = lambda n: tables[n].where(F.col("run_id") == run_id)
    members, items, partitions = own("discovery_memberships"), own("manifest_items"), own("discovery_partitions")
    run = tables["acquisition_runs"].where(F.col("id") == run_id).select(F.col("id").alias("run_id"), "status", "frozen_at")
    as_map = lambda df, k, v: df.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(k), F.col(v))))))
    instruments = members.join(tables["source_records"].select("provider", "source_id", "instrument_id"), ["provider", "source_id"], "left").agg(F.count("*").alias("memberships"), F.count_distinct("provider", "source_id").alias("sources"), F.count_distinct("instrument_id").alias("distinct_instruments"))
    global_ = tables["source_records"].agg(F.count("*").alias("global_source_records")).join(tables["instruments"].agg(F.count("*").alias("global_instruments")))
    types = partitions.agg(F.count_distinct("type_id").alias("types_selected"), F.array_sort(F.collect_set("group")).alias("groups"))
    files = files_of_run(tables["document_files"], items)
    manifest = as_map(status_counts(items), "status", "n").toDF("manifest")
    states = as_map(status_counts(partitions), "status", "n").toDF("partitions")
    file_states = as_map(status_counts(files), "status", "n").toDF("files")
    flags = items.agg(*[F.count_if(F.col("status") == s).alias(a) for s, a in (("done", "documents_downloaded"), ("no_file", "no_file"), ("partial", "partial"), ("failed", "failed"), ("unresolved", "unresolved"), ("out_of_scope", "out_of_scope"))])
    stored = storage(files, tables["objects"]).select(F.struct(F.col("file_links").alias("pdf_count"), "pdf_bytes", "pdf_unique_sha256", "duplicate_sha256", "file_links", "logical_bytes", "physical_bytes").alias("objects"))
    whole = tables["objects"].agg(F.struct(F.count("*").alias("objects"), F.coalesce(F.sum("logical_size"), F.lit(0)).cast("bigint").alias("logical_unique_bytes"), F.coalesce(F.sum("stored_size"), F.lit(0)).cast("bigint").alias("physical_bytes")).alias("global_storage"))
    compared = partition_counts(partitions, members).agg(F.array_sort(F.collect_list(F.struct("group", "type_id", "year", "status", "reported_total", "members"))).alias("coverage_reference"))
    out = run
    for part in (instruments, global_, types, compared, manifest, states, file_states, flags, stored, whole):
        out = out.join(part)
    return out


def in_scope(types: DataFrame, group: str, wanted: list[str] | None = None) -> DataFrame:
    """Types whose verified class is the requested group, restricted to ids if given."""
    rows = types.where(F.col("classification") == group)
    return rows.where(F.col("type_id").isin(*wanted)) if wanted else rows


def unknown_ids(spark, wanted: list[str], types: DataFrame) -> DataFrame:
    """Requested type ids that the catalog hasn't."""
    return spark.createDataFrame([(w,) for w in wanted], "type_id string").join(types.select("type_id"), "type_id", "left_anti")


def plan(types: DataFrame, from_year: int | None = None, to_year: int | None = None) -> DataFrame:
    """One row: types, partitions (types times years, or one each) and the reported total (missing ones are zero)."""
    years = 1 if from_year is None else max(0, to_year - from_year + 1)
    return types.agg(F.count("*").alias("types"), (F.count("*") * years).alias("partitions"), F.coalesce(F.sum(F.coalesce("reported_total", F.lit(0))), F.lit(0)).cast("bigint").alias("reported_total"))


def year_partitions(types: DataFrame, from_year: int | None = None, to_year: int | None = None) -> DataFrame:
    """A partition for each type and year; year 0 where no years are given."""
    years = F.array(F.lit(0)) if from_year is None else F.sequence(F.lit(from_year), F.lit(to_year))
    return types.withColumn("year", F.explode(years))


def sync_years(current: int, pilot: int, overlap: int) -> tuple[int, int]:
    """Years that a sync observes again."""
    return max(pilot, current - overlap), current


def out_of_scope(requested: Column, found: Column, location: Column, form: Column) -> Column:
    """Another year than requested, or a regional location or form."""
    wrong = (F.coalesce(requested, F.lit(0)) != 0) & (F.coalesce(found, F.lit(0)) != 0) & (requested != found)
    place, kind = F.lower(F.coalesce(location, F.lit(""))), F.lower(F.coalesce(form, F.lit("")))
    regional = place.contains("kabupaten") | place.contains("kota ") | place.contains("provinsi")
    for name in T.REGIONAL_FORMS:
        regional = regional | kind.contains(name)
    return wrong | regional


def unresolved_class(items: DataFrame, memberships: DataFrame, types: DataFrame) -> DataFrame:
    """``items`` (run_id, provider, source_id, observed_type_id, observed_type) with unresolved_class.

    The observed type id must be one of the item's memberships; without an id, the type's name must be.
    """
    name = lambda c: F.regexp_replace(T.folded(c), r"\s+", " ")
    named = memberships.join(types.select("type_id", F.trim(name("name")).alias("type_name")), "type_id", "left")
    known = named.groupBy("run_id", "provider", "source_id").agg(F.collect_set("type_id").alias("__ids"), F.collect_set("type_name").alias("__names"))
    joined = items.join(known, ["run_id", "provider", "source_id"], "left")
    by_id = F.array_contains("__ids", F.col("observed_type_id"))
    by_name = F.array_contains("__names", F.trim(name("observed_type")))
    ok = F.when(F.col("observed_type_id").isNotNull(), by_id).otherwise(by_name)
    return joined.withColumn("unresolved_class", ~F.coalesce(ok, F.lit(False))).drop("__ids", "__names")


def resumable_run(runs: DataFrame, provider: str, fingerprint: str, statuses=("discovering", "partial", "ready", "running")) -> DataFrame:
    """The newest run of a scope that can go on, if any."""
    found = runs.where((F.col("provider") == provider) & (F.col("scope_fingerprint") == fingerprint) & F.col("status").isin(*statuses))
    return found.agg(F.max_by(F.struct("*"), "id").alias("r")).where("r IS NOT NULL").select("r.*")


def exists_keys(keys: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Keys that a table has."""
    return keys.join(table.select(*on), on, "left_semi")


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row of counters over item outcomes."""
    names = ("done", "no_file", "partial", "failed", "unresolved", "out_of_scope")
    return outcomes.agg(
        F.count("*").alias("processed"),
        *[F.count_if(F.col("status") == s).alias(s) for s in names],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("expected", "downloaded", "file_failures", "new_objects", "duplicate_objects", "bytes")],
    )
