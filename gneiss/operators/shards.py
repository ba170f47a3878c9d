"""Bounded prefixes, greedy sequential shards and offset manifests."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions.values import canonical_json
from gneiss.operators.quality import within_budget


def bounded_prefix(files: DataFrame, order: str, size: str, most_files: int, most_bytes: int) -> DataFrame:
    """The first rows by ``order`` up to a number of rows and a sum of sizes (sizes aren't negative)."""
    first = files.orderBy(order).limit(most_files)
    return within_budget(first, order, size, most_bytes).where("fits").drop("fits")


def greedy_shards(files: DataFrame, order: str, size: str, cap: int) -> DataFrame:
    """``files`` with shard: a shard closes when the next file would take it over ``cap``; a larger file is alone.

    The rule is sequential over all files.  A task needs only key and size, in order and as a stream:
    the fold keeps two numbers, so one task handles any number of rows; the shard numbers are joined back.
    """
    lean = files.select(order, F.col(size).cast("bigint").alias("__size")).repartitionByRange(1, order).sortWithinPartitions(order)
    kind = files.schema[order].dataType.simpleString()

    def run(batches):
        shard = held = 0
        for batch in batches:
            out = []
            for n in batch.column(1).to_pylist():
                n = n or 0
                if held and held + n > cap:
                    shard, held = shard + 1, 0
                held += n
                out.append(shard)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], [order, "shard"])

    return files.join(lean.mapInArrow(run, f"`{order}` {kind}, shard bigint"), order)


def unit_ids(shards: DataFrame, key: str, size: str) -> DataFrame:
    """By shard: members in order, sizes, bytes and the unit id (shard: and 24 hex digits over key:size)."""
    members = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), F.col(size).cast("bigint").alias("size"))))
    g = shards.groupBy("shard").agg(members.alias("m"), F.sum(size).cast("bigint").alias("bytes"))
    text = F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["key"], x["size"].cast("string"))), "|")
    return g.select("shard", "bytes", F.size("m").alias("files"), F.transform("m", lambda x: x["key"]).alias("members"), F.transform("m", lambda x: x["size"]).alias("sizes"), F.concat(F.lit("shard:"), F.substring(F.sha2(text, 256), 1, 24)).alias("unit_id"))


def offset_manifest(shards: DataFrame, key: str, size: str) -> DataFrame:
    """``shards`` with offset in the shard, the manifest line of each member, and its size in bytes."""
    before = Window.partitionBy("shard").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    out = shards.withColumn("offset", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("bigint"))
    line = canonical_json(offset=F.col("offset"), sha256=F.col(key), size=F.col(size))
    return out.withColumn("line", line).withColumn("line_bytes", (F.octet_length("line") + 1).cast("bigint"))
