"""Scratch folders that the whole cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder below the session's checkpoint folder; a temporary one for a local session without one (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = "file://" + tempfile.mkdtemp(prefix="gneiss-")
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` from a table that is written once, so that all later plans see the same rows in the same partitions."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, *order: Column | str, amount: Column, part: str = "part", before: str = "before") -> tuple[DataFrame, DataFrame]:
    """``df`` in range partitions by ``order`` with their number, and by that number the ``amount`` of all partitions before.

    The table is written: range bounds are sampled whenever an exchange runs, and two exchanges may differ.
    """
    parts = written(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    held = parts.groupBy(part).agg(amount.alias("__held"))
    earlier = F.sum("__held").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition
    return parts, held.withColumn(before, F.coalesce(earlier, F.lit(0))).drop("__held")


def spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """``df`` dealt by ``keys`` to all cores, for work on each row that costs far more than moving it.

    A file of one row group is one task otherwise.  The partitions are as many as the session's shuffles or cores.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)
