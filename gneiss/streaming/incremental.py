"""Structured Streaming over the merge policies, discovery by arriving pages, and event-time extras."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gneiss.operators import quality
from gneiss.sources.readers import Config


class VersionedTable:
    """A Parquet table whose state after each batch is a folder of its own; the newest folder is the table.

    A batch that is run again writes its folder again from the one before, so replays change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        """Batches whose folder was written whole."""
        fs, p = self._fs()
        if not fs.exists(p):
            return []
        done = [s.getPath() for s in fs.listStatus(p)]
        jvm = self.spark.sparkContext._jvm
        return sorted(int(d.getName()[1:]) for d in done if d.getName().startswith("v") and fs.exists(jvm.org.apache.hadoop.fs.Path(d, "_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        """The table, or its state before a batch; empty at first."""
        held = [v for v in self.versions() if before is None or v < before]
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{held[-1]}")

    def write(self, batch: int, df: DataFrame) -> None:
        """The table's state after a batch; states older than the last two go."""
        df.select(*self.spark.createDataFrame([], self.schema).columns).write.mode("overwrite").parquet(f"{self.path}/v{batch}")
        fs, p = self._fs()
        jvm = self.spark.sparkContext._jvm
        for v in self.versions()[:-2]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(p, f"v{v}"), True)


def merge_stream(stream: DataFrame, table: VersionedTable, policy: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str):
    """A query that applies a merge policy to every batch of a stream (which has a seq column); returns it when the input is used up."""

    def apply(batch: DataFrame, number: int) -> None:
        table.write(number, policy(table.read(before=number), batch))

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def discover(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manifest items and partition states from parsed result pages (see ``search_pages``).

    Pages of a partition count up to the first with an error; an item is added once, by its first page.
    A partition is complete where a counted page says that there is no more, partial behind an error,
    else discovering with its next page.
    """
    keys = ["run_id", "group", "type_id", "year"]
    ids = pages.withColumn("ids", F.transform("documents", lambda d: d["source_id"]))
    checked = quality.page_errors(ids)
    order = Window.partitionBy(*keys).orderBy("page")
    counted = checked.withColumn("__bad", F.max(F.col("error").isNotNull()).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    good = counted.where(~F.col("__bad"))
    items = good.select(*keys, "page", F.posexplode("documents").alias("at", "d"))
    first = items.withColumn("n", F.row_number().over(Window.partitionBy("run_id", "d.provider", "d.source_id").orderBy(*keys[1:], "page", "at"))).where("n = 1")
    manifest = first.select("run_id", "d.*", "group", "type_id", "year")
    found = items.groupBy(*keys).agg(F.count_distinct("d.source_id").alias("discovered_count"))
    state = counted.groupBy(*keys).agg(
        F.max(F.when(~F.col("__bad"), F.struct("page", "has_more", "next_page", "signature"))).alias("last"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("page"))).alias("last_error"),
        F.max("reported_total").alias("reported_total"),
    )
    status = F.when(F.col("last_error").isNotNull(), "partial").when(~F.col("last.has_more"), "complete").otherwise("discovering")
    partitions = state.join(found, keys, "left").select(*keys, status.alias("status"), F.coalesce("last.next_page", F.col("last.page") + 1, F.lit(1)).alias("next_page"), "reported_total", F.coalesce("discovered_count", F.lit(0)).alias("discovered_count"), F.col("last.signature").alias("last_signature"), "last_error")
    return manifest, partitions


def legacy_segments(pages: DataFrame) -> DataFrame:
    """States of segments by year, which end at the first recognised empty page; a repeated page is an error."""
    order = Window.partitionBy("run_id", "year").orderBy("page")
    signed = pages.withColumn("signature", F.sha2(F.to_json(F.transform("documents", lambda d: d["source_id"])), 256))
    repeat = (F.size("documents") > 0) & (F.col("signature") == F.lag("signature").over(order))
    ended = signed.withColumn("empty", F.col("parser_ok") & (F.size("documents") == 0)).withColumn("repeat", F.coalesce(repeat, F.lit(False)))
    return ended.groupBy("run_id", "year").agg(
        F.when(F.max("repeat"), "partial").when(F.max("empty"), "complete").otherwise("discovering").alias("status"),
        F.coalesce(F.min(F.when(F.col("empty") | F.col("repeat"), F.col("page"))), F.max("page") + 1).alias("next_page"),
        F.sum(F.size("documents")).cast("bigint").alias("discovered_count"),
    )


def start_run(runs: DataFrame, scope: dict, provider: str, now: str, fresh: bool = False) -> tuple[DataFrame, int, bool]:
    """The runs with one for the scope: an unfinished one of the same identity, or a new one; its id, and whether it is new."""
    import json

    from gneiss.functions.values import scope_fingerprint
    from gneiss.operators.registry import resumable_run

    mark = scope_fingerprint(scope)
    if not fresh and (found := resumable_run(runs, provider, mark).select("id").first()):
        return runs, found[0], False
    number = (runs.agg(F.max("id")).first()[0] or 0) + 1
    years = scope.get("from_year"), scope.get("to_year")
    row = {"id": number, "mode": "scoped", "provider": provider, "from_year": years[0], "to_year": years[1], "status": "discovering", "created_at": now, "metadata_json": "{}", "scope_json": json.dumps(scope, sort_keys=True, separators=(",", ":"), ensure_ascii=False), "scope_fingerprint": mark}
    new = runs.sparkSession.createDataFrame([tuple(row.get(f.name) for f in runs.schema.fields)], runs.schema)
    return runs.unionByName(new), number, True


def sync_scope(config: Config, current_year: int) -> dict:
    """The years that an incremental run observes again."""
    from gneiss.operators.registry import sync_years

    lo, hi = sync_years(current_year, config.pilot_year, config.overlap_years)
    return {"from_year": lo, "to_year": hi, "all_years": False}


def latest_by_key(events: DataFrame, key: str, time: str, *order: str) -> DataFrame:
    """The newest row of each key in a bounded table."""
    return events.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(time, *order)).alias("r")).select("r.*")


def distinct_events(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Events without repeats that arrive within the watermark (streams and tables)."""
    marked = events.withWatermark(time, late)
    return marked.dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])


def windowed(events: DataFrame, time: str, width: str, *by: str, late: str = "1 hour", value: str = "value") -> DataFrame:
    """Counts and sums in tumbling event-time windows."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), *by, "n", "total")


def sessions(events: DataFrame, key: str, time: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of each key, closed by a gap."""
    return events.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
