"""Merge policies as functions (current, updates) -> next.

Arrival order is the column ``seq`` of the updates; rows of the current table come before all of them.
Each policy is one union and one aggregation by key, so replaying a batch changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def _stacked(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Both with __seq; the current rows at -1."""
    new = updates.withColumn("__seq", F.col("seq").cast("bigint")).drop("seq")
    return new if current is None else current.withColumn("__seq", F.lit(-1).cast("bigint")).unionByName(new, allowMissingColumns=True)


def fold(current: DataFrame | None, updates: DataFrame, keys: list[str], *, keep=(), newest=(), coalesced=(), added=()) -> DataFrame:
    """One row a key: ``keep`` from its first row, ``newest`` from its last, ``coalesced`` the last value that isn't null, ``added`` summed."""
    rows = _stacked(current, updates)
    value = lambda c: F.struct(F.col(c).alias("v"))  # noqa: E731  a struct isn't null: max_by keeps null values
    out = [F.min_by(value(c), "__seq")["v"].alias(c) for c in keep]
    out += [F.max_by(value(c), "__seq")["v"].alias(c) for c in newest]
    out += [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("__seq"))).alias(c) for c in coalesced]
    out += [F.sum(F.coalesce(F.col(c), F.lit(0))).cast(dict(rows.dtypes)[c]).alias(c) for c in added]
    return rows.groupBy(*keys).agg(*out)


def first_wins(current: DataFrame | None, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-or-ignore: the earliest row of each key.  Nulls in keys are equal."""
    rows = _stacked(current, updates)
    rest = [c for c in rows.columns if c not in (*keys, "__seq")]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), "__seq").alias("r")).select(*keys, "r.*")


def last_wins(current: DataFrame | None, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Overwrite: the latest row of each key."""
    rows = _stacked(current, updates)
    rest = [c for c in rows.columns if c not in (*keys, "__seq")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__seq").alias("r")).select(*keys, "r.*")


def first_wins_null_distinct(current: DataFrame | None, updates: DataFrame, keys: list[str], nullable: str) -> DataFrame:
    """Insert-or-ignore where a null in ``nullable`` equals nothing: such rows are all kept."""
    bare = lambda d: None if d is None else d.where(F.col(nullable).isNotNull())
    known = first_wins(bare(current), bare(updates), keys)
    loose = updates.where(F.col(nullable).isNull()).drop("seq")
    if current is not None:
        loose = current.where(F.col(nullable).isNull()).unionByName(loose, allowMissingColumns=True)
    return known.unionByName(loose, allowMissingColumns=True)


def upsert_instruments(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Newest facts; issuing body and status stay while an update has none; created_at is the first."""
    return fold(current, updates, ["id"], keep=["created_at"], newest=["document_type", "number", "year", "title", "jurisdiction", "metadata_json", "updated_at"], coalesced=["issuing_body", "status"])


def insert_objects(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """The first record of each object."""
    return first_wins(current, updates, ["sha256"])


def new_objects(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Only the rows that ``insert_objects`` adds, for an append."""
    fresh = updates.join(current.select("sha256"), "sha256", "left_anti")
    return first_wins(None, fresh, ["sha256"])


def record_observations(events: DataFrame | None, compact: DataFrame | None, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The fetch log (distinct with its time) and the compact table (distinct without; hashless rows all stay)."""
    key = ["provider", "source_url", "content_sha256"]
    return first_wins_null_distinct(events, updates, [*key, "retrieved_at"], "content_sha256"), first_wins_null_distinct(compact, updates, key, "content_sha256")


def upsert_source_records(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Newest url, sighting and metadata; title, instrument, check and hash stay while an update has none."""
    return fold(current, updates, ["provider", "source_id"], keep=["first_seen_at"], newest=["detail_url", "last_seen_at", "metadata_json"], coalesced=["title_hint", "instrument_id", "last_checked_at", "latest_detail_sha256"])


def touch_source_records(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """As a manifest does it: newest url and sighting, title while given; all else stays."""
    keep = ["first_seen_at", "instrument_id", "last_checked_at", "latest_detail_sha256", "metadata_json"]
    return fold(current, updates, ["provider", "source_id"], keep=keep, newest=["detail_url", "last_seen_at"], coalesced=["title_hint"])


def insert_references(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Distinct edges; a missing label or context is the empty text."""
    filled = updates.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("context_label", "raw_context")})
    return first_wins(current, filled, ["provider", "source_url", "target_url", "context_label", "raw_context"])


def add_manifest_items(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Insert-or-ignore by item; the metadata is the first that isn't {} in order of arrival."""
    keys = ["run_id", "provider", "source_id"]
    rows = _stacked(current, updates)
    rest = [c for c in rows.columns if c not in (*keys, "__seq", "metadata_json")]
    told = F.when(F.coalesce(F.col("metadata_json"), F.lit("{}")) != "{}", F.col("__seq"))
    folded = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), "__seq").alias("r"), F.coalesce(F.min_by("metadata_json", told), F.lit("{}")).alias("metadata_json"))
    return folded.select(*keys, "r.*", "metadata_json")


def count_added(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many new keys a batch brings (added)."""
    return updates.select(*keys).distinct().join(current.select(*keys).distinct(), keys, "left_anti").agg(F.count("*").alias("added"))


def add_memberships(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Distinct memberships."""
    columns = ["run_id", "provider", "source_id", "group", "type_id", "year"]
    rows = updates.select(*columns)
    return (rows if current is None else current.select(*columns).unionByName(rows)).distinct()


def expect_files(current: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Expected files are added once and change nothing that is known."""
    rows = updates.select("provider", "source_id", "detail_sha256", "url", F.lit("expected").alias("status"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("string").alias("error"), F.lit("{}").alias("metadata_json"), "seq")
    return first_wins(current, rows, ["provider", "source_id", "detail_sha256", "url"])


def record_file_results(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Results overwrite status, hash, error and metadata of files that are expected."""
    keys = ["provider", "source_id", "detail_sha256", "url"]
    return last_wins(current, updates.join(current.select(*keys), keys, "left_semi"), keys)


def update_partitions(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Only values that are given overwrite; updated_at is the newest."""
    rest = [c for c in current.columns if c not in (*keys, "updated_at")]
    return fold(current, updates, keys, newest=["updated_at"], coalesced=rest).select(*current.columns)


def transition_items(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Status changes of items: attempts add up, ids stay while none is given, the error is the newest."""
    kept = [c for c in current.columns if c not in ("id", "status", "last_error", "updated_at", "instrument_id", "detail_sha256", "attempts")]
    rows = updates.join(current.select("id"), "id", "left_semi")
    # a first row that is an update only has nulls in the kept columns: the current row always comes first
    return fold(current, rows, ["id"], keep=kept, newest=["status", "last_error", "updated_at"], coalesced=["instrument_id", "detail_sha256"], added=["attempts"]).select(*current.columns)


def transition_runs(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Run statuses: started_at at the first running, finished_at at each end."""
    done = F.col("status").isin("complete", "partial", "failed")
    steps = updates.withColumns({"started_at": F.when(F.col("status") == "running", F.col("at")), "finished_at": F.when(done, F.col("at"))})
    rows = _stacked(current, steps.drop("at"))
    kept = [c for c in current.columns if c not in ("id", "status", "started_at", "finished_at")]
    return rows.groupBy("id").agg(
        *[F.min_by(F.struct(F.col(c).alias("v")), "__seq")["v"].alias(c) for c in kept],
        F.max_by("status", "__seq").alias("status"),
        F.min_by("started_at", F.when(F.col("started_at").isNotNull(), F.col("__seq"))).alias("started_at"),
        F.max_by("finished_at", F.when(F.col("finished_at").isNotNull(), F.col("__seq"))).alias("finished_at"),
    ).select(*current.columns)


def item_status(items: DataFrame) -> DataFrame:
    """Final status of each item from failed, wrong_year, regional, instrument_id, unresolved_class, files, expected, downloaded, file_failures."""
    status = (
        F.when(F.col("failed"), "failed")
        .when(F.col("wrong_year") | F.col("regional"), "out_of_scope")
        .when(F.col("instrument_id").isNull() | F.col("unresolved_class"), "unresolved")
        .when(F.col("files") == 0, "no_file")
        .when((F.col("file_failures") > 0) | (F.col("expected") != F.col("downloaded")), "partial")
        .otherwise("done")
    )
    return items.withColumn("status", status)


def run_status(items: DataFrame) -> DataFrame:
    """partial while an item of the run is open or failed, else complete."""
    open_ = F.count_if(F.col("status").isin("pending", "running", "failed", "partial", "unresolved"))
    return items.groupBy("run_id").agg(F.when(open_ > 0, "partial").otherwise("complete").alias("status"))


def pending(units: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that no earlier run has finished."""
    return units.join(done.select(*keys).distinct(), keys, "left_anti")


def revisions(history: DataFrame | None, updates: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Every version of a key with the time it was first and last seen, and whether it is the current one."""
    rows = _stacked(history, updates)
    first = F.coalesce(F.col("first_seen_at"), F.col("seen_at")) if "first_seen_at" in rows.columns else F.col("seen_at")
    last = F.coalesce(F.col("last_seen_at"), F.col("seen_at")) if "last_seen_at" in rows.columns else F.col("seen_at")
    seen = rows.groupBy(*keys, version).agg(F.min(first).alias("first_seen_at"), F.max(last).alias("last_seen_at"))
    newest = Window.partitionBy(*keys).orderBy(F.desc("last_seen_at"), F.desc("first_seen_at"), F.desc(version))
    return seen.withColumn("is_current", F.row_number().over(newest) == 1)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """One table of several, missing columns as nulls."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
