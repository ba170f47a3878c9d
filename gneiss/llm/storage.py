"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    Where a local session names no such folder (tests), a temporary one is set; on a cluster that is an error.
    The folder goes when the Python process ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
            base = "file://" + tempfile.mkdtemp(prefix="gneiss-")
            spark.sparkContext.setCheckpointDir(base)
        _ROOTS[app] = f"{base.rstrip('/')}/gneiss-{app}"
        atexit.register(_forget, spark, _ROOTS[app])
    return _ROOTS[app]


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may have gone before us; nothing else depends on the folder by then
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: later plans start from the files.

    A lost executor costs its running tasks only, and no earlier stage runs twice.
    """
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written = path  # for discard()
    return back


def discard(*frames: DataFrame) -> None:
    """Delete the files of materialized frames that no later plan reads."""
    for df in frames:
        spark = df.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def shielded(docs: DataFrame, used: tuple[str, ...], work) -> DataFrame:
    """``work(docs)``, which keeps its columns, with all columns but the used ones under names that clash with none."""
    names = docs.columns
    away = [c if c in used else f"__own{k}" for k, c in enumerate(names)]
    return work(docs.toDF(*away)).select(*[F.col(a).alias(c) for a, c in zip(away, names, strict=True)])


def fence(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with the named columns behind a generator of one row.

    The optimizer moves no filter through it, so a filter on a computed column doesn't copy that column's
    expressions, lambdas and all, into the filter.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in columns]))))


def release(spark: SparkSession) -> None:
    """Let the driver find the shuffles that no plan needs any more, so that executors drop their files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
