"""Scans of registry, inventory, checkpoint and object data."""

from __future__ import annotations

import tomllib
import zlib
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.functions.values import canonical_json
from gneiss.sources.schemas import OPEN, RETRY


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scan(df: DataFrame, *order: str, where: Column | None = None) -> DataFrame:
    """A table in key order, filtered if asked."""
    return (df if where is None else df.where(where)).orderBy(*order)


def latest(df: DataFrame, by: str) -> DataFrame:
    """The row with the largest value of ``by``."""
    return df.agg(F.max_by(F.struct("*"), by).alias("r")).where("r IS NOT NULL").select("r.*")


def keyset_batch(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next ``size`` rows behind a key."""
    rows = df if after is None else df.where(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def batches(df: DataFrame, key: str, size: int):
    """Whole table in key order as batches of rows; one batch is held at a time."""
    after = None
    while rows := keyset_batch(df, key, after, size).collect():
        yield rows
        after = rows[-1][key]


def open_items(items: DataFrame, run_id, retry: bool = False, limit: int | None = None) -> DataFrame:
    """Manifest items of a run that wait for work, by id: those begun or pending, with ``retry`` failed ones too."""
    if limit is not None and limit < 0:
        raise ValueError("a limit can't be negative")
    wanted = [*OPEN, *(RETRY if retry else ())]
    rows = items.where((F.col("run_id") == run_id) & F.col("status").isin(*wanted)).orderBy("id")
    return rows.limit(limit) if limit else rows


def manifest(items: DataFrame, run_id, include_failed: bool = False) -> DataFrame:
    """A run's open (and failed) items by year and id."""
    wanted = [*OPEN, *(("failed",) if include_failed else ())]
    return items.where((F.col("run_id") == run_id) & F.col("status").isin(*wanted)).orderBy("year", "id")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """A JSON inventory, {"files": [...]} or a bare list: path, sha256 (lower case), logical_size, stored_size, sources."""
    rows = spark.read.option("multiLine", True).json(path)
    if "files" in rows.columns:
        rows = rows.select(F.explode("files").alias("f")).select("f.*")
    sizes = [F.col(c).cast("bigint") for c in ("logical_size", "size") if c in rows.columns]
    stored = [F.col("stored_size").cast("bigint")] if "stored_size" in rows.columns else []
    extra = ["sources"] if "sources" in rows.columns else []
    return rows.select("path", F.lower("sha256").alias("sha256"), F.coalesce(*sizes).alias("logical_size"), F.coalesce(*stored, *sizes).alias("stored_size"), *extra)


def identify_inventory(files: DataFrame, expected: int | None = None) -> tuple[DataFrame, str]:
    """The inventory by sha256 and its identity: SHA-256 over the rows' canonical JSON without paths.

    Raises ValueError for equal keys or another number of files than ``expected``.
    """
    facts = files.agg(F.count("*"), F.count_distinct("sha256")).first()
    if facts[0] != facts[1]:
        raise ValueError("the inventory names a file twice")
    if expected is not None and facts[0] != expected:
        raise ValueError(f"the inventory has {facts[0]} files, not {expected}")
    line = canonical_json(**{c: F.col(c) for c in files.columns if c not in ("path", "stored_size")})
    rows = files.select("sha256", F.sha2(line, 256).alias("h"))
    # hashes of rows, then of buckets of rows: no list of all rows in one task
    buckets = rows.groupBy(F.substring("sha256", 1, 3).alias("bucket")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sha256", "h"))), lambda r: r["h"]), "|"), 256).alias("h"))
    whole = buckets.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "h"))), lambda r: r["h"]), "|"), 256)).first()[0]
    return files.orderBy("sha256"), whole


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON-lines checkpoints; an unreadable last line of a file is dropped, any other raises.

    Files are read by lines; only unreadable ones are compared with the places where their files end.
    """
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), at.alias("at"), F.try_parse_json("value").isNotNull().alias("ok"))
    ends = lines.groupBy("file").agg(F.max("at").alias("end"))
    wrong = lines.where(~F.col("ok")).join(ends, "file").where(F.col("at") != F.col("end"))
    raised = wrong.select(F.raise_error(F.concat(F.lit("a line of "), F.col("file"), F.lit(" can't be read"))).cast("string").alias("value"))
    sound = lines.where("ok").select("value").unionByName(raised)
    return sound.select(F.from_json("value", schema).alias("row")).select("row.*")


def json_rows(df: DataFrame, column: str, schema: str, *order: str) -> DataFrame:
    """A table whose values are JSON texts, as columns."""
    rows = df.select(*[c for c in df.columns if c != column], F.from_json(column, schema).alias("__v"))
    rows = rows.select(*[c for c in df.columns if c != column], "__v.*")
    return rows.orderBy(*order) if order else rows


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header, read with a known schema."""
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', multiLine=True)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """What ``sinks.write_objects`` wrote, with the content as it was before compression, and error."""
    return gunzip(spark.read.parquet(path).drop("sha_prefix"))


def read_objects(spark: SparkSession, path: str) -> DataFrame:
    """Stored objects: path, sha256 of the name, content as it was before compression, stored_size, error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    named = files.select("path", F.regexp_extract("path", r"([0-9a-f]{64})[^/]*$", 1).alias("sha256"), F.col("length").alias("stored_size"), "content")
    return gunzip(named)


def gunzip(df: DataFrame, content: str = "content", path: str = "path") -> DataFrame:
    """``df`` with the content of rows whose path ends in .gz unpacked; error says why one can't be."""
    at, name = df.columns.index(content), df.columns.index(path)

    def run(batches):
        for batch in batches:
            out, errors = [], []
            for raw, where in zip(batch.column(at), batch.column(name).to_pylist(), strict=True):
                value, error = raw.as_py(), None
                if value is not None and (where or "").endswith(".gz"):
                    try:
                        value = zlib.decompress(value, 31)
                    except zlib.error as e:
                        value, error = None, str(e)
                out.append(value)
                errors.append(error)
            columns = [pa.array(out, pa.binary()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(errors, pa.string())], [*batch.schema.names, "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, fields + ", error string")


@dataclass
class Config:
    """Settings with their defaults; numbers are kept in range."""

    root: str = "archive"
    base_url: str = ""
    timeout_seconds: float = 30.0
    request_delay_seconds: float = 1.0
    retries: int = 4
    pilot_year: int = 2026
    overlap_years: int = 1
    reserve_bytes: int = 0
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        self.timeout_seconds = max(1.0, float(self.timeout_seconds))
        self.request_delay_seconds = max(0.0, float(self.request_delay_seconds))
        self.retries = max(0, int(self.retries))
        self.overlap_years = max(0, int(self.overlap_years))
        self.reserve_bytes = max(0, int(self.reserve_bytes))


def load_config(path: str | None = None) -> Config:
    """A TOML file's settings over the defaults; unknown keys are kept in ``extra``."""
    if path is None or not Path(path).exists():
        return Config()
    with open(path, "rb") as f:
        data = tomllib.load(f)
    flat = {k: v for part in data.values() if isinstance(part, dict) for k, v in part.items()} | {k: v for k, v in data.items() if not isinstance(v, dict)}
    known = {k: v for k, v in flat.items() if k in Config.__dataclass_fields__ and k != "extra"}
    return Config(**known, extra={k: v for k, v in flat.items() if k not in known})
