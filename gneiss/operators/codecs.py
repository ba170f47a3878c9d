"""Lossless codecs with exactness receipts, for single documents and for shards."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions import values as V
from gneiss.operators.merge import pending
from gneiss.operators.profile import distribution
from gneiss.operators.trials import FIELDS, isolated, trial
from gneiss.sources.workspace import spread

METHODS = ("gzip9", "zstd3", "zstd9", "zstd19", "lzma2")

_SCHEMA = "status string, input_bytes bigint, payload_bytes bigint, manifest_bytes bigint, output_bytes bigint, encode_seconds double, decode_seconds double, exact boolean, member_sha256 array<string>, error string, peak_rss_bytes bigint"


def _outcome(data: list[bytes], method: str, manifest_bytes: int, seconds: float | None, rss_bytes: int | None) -> dict:
    """FIELDS of a trial over one unit's members; with a limit, in a process of its own."""
    asked = b"".join(data), method, [len(d) for d in data], [hashlib.sha256(d).hexdigest() for d in data], manifest_bytes
    limited = seconds is not None or rss_bytes is not None
    return dict(zip(FIELDS, isolated(*asked, seconds, rss_bytes) if limited else trial(*asked), strict=True))


def _with_rates(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "encode_mib_s": V.throughput("input_bytes", "encode_seconds"),
            "decode_mib_s": V.throughput("input_bytes", "decode_seconds"),
            "ratio": V.ratio("output_bytes", "input_bytes"),
            "saving": V.saving("input_bytes", "output_bytes"),
        }
    )


def benchmark_documents(docs: DataFrame, key: str, content: str, methods=METHODS, done: DataFrame | None = None, seconds: float | None = None, rss_bytes: int | None = None) -> DataFrame:
    """A row for every document and method that ``done`` (unit_id, method) hasn't: sizes, times, exactness.

    With a limit of seconds or of memory each trial runs in a process of its own, whose peak is kept; a trial beyond
    a limit has status timeout or resource_limit.
    """
    units = docs.select(F.concat(F.lit("doc:"), F.col(key).cast("string")).alias("unit_id"), F.col(content).cast("binary").alias("content"))
    units = spread(units, "unit_id").withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    if done is not None:
        units = pending(units, done, ["unit_id", "method"])

    def run(batches):
        for batch in batches:
            ids, data, how = (batch.column(k).to_pylist() for k in range(3))
            out = [{"unit_id": u, "method": m} | _outcome([d or b""], m, 0, seconds, rss_bytes) for u, d, m in zip(ids, data, how, strict=True)]
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = _arrow("unit_id string, method string, " + _SCHEMA)
    made = units.select("unit_id", "content", "method").mapInArrow(run, "unit_id string, method string, " + _SCHEMA)
    return _with_rates(made).withColumns({"mode": F.lit("perdoc"), "independent_access": F.lit(True)})


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    return pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in ddl.split(", ")])


def benchmark_shards(members: DataFrame, key: str, content: str, methods=METHODS, seconds: float | None = None, rss_bytes: int | None = None) -> DataFrame:
    """A row for every shard and method.  ``members`` has shard, unit_id, manifest_bytes, the key and the content.

    A shard's size has a cap (see greedy_shards), so a task holds one shard at a time.  Limits are those of ``benchmark_documents``.
    """
    rows = members.select("shard", "unit_id", "manifest_bytes", F.col(key).cast("string").alias("k"), F.col(content).cast("binary").alias("c"))
    rows = rows.withColumn("method", F.explode(F.array(*[F.lit(m) for m in methods])))
    schema = _arrow("unit_id string, method string, " + _SCHEMA)

    def run(key, table):
        table = table.sort_by("k")
        data = [x or b"" for x in table.column("c").to_pylist()]
        made = _outcome(data, key[1].as_py(), table.column("manifest_bytes")[0].as_py() or 0, seconds, rss_bytes)
        return pa.Table.from_pylist([{"unit_id": table.column("unit_id")[0].as_py(), "method": key[1].as_py()} | made], schema)

    made = rows.groupBy("shard", "method").applyInArrow(run, "unit_id string, method string, " + _SCHEMA)
    return _with_rates(made).withColumns({"mode": F.lit("shard"), "independent_access": F.lit(False)})


def stream_trials(streams: DataFrame, codec: str, key: str, content: str, method: str = "zstd9") -> DataFrame:
    """Wrapping of sampled streams by another codec: what each gains, and whether it comes back whole."""
    made = benchmark_documents(streams, key, content, (method,))
    named = streams.select(F.concat(F.lit("doc:"), F.col(key).cast("string")).alias("unit_id"), codec, F.col(key).cast("string").alias("key"))
    return made.join(named, "unit_id")


def saving_distribution(rows: DataFrame, *by: str) -> DataFrame:
    """Distribution of the saving of single exact units."""
    good = rows.where((F.col("status") == "ok") & F.coalesce(F.col("exact"), F.lit(False)))
    return good.withColumn("unit_saving", V.saving("input_bytes", "output_bytes")).groupBy(*by).agg(*distribution("unit_saving"))


def rollup(rows: DataFrame, *by: str) -> DataFrame:
    """Byte-weighted results: units and statuses of all rows, bytes, times and saving of exact ones."""
    good = (F.col("status") == "ok") & F.coalesce(F.col("exact"), F.lit(False))
    total = lambda c: F.sum(F.when(good, F.col(c)))
    states = rows.groupBy(*by, "status").agg(F.count("*").alias("n")).groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("statuses"))
    out = rows.groupBy(*by).agg(
        F.count("*").alias("units"),
        F.count_if(good).alias("good"),
        total("input_bytes").cast("bigint").alias("input_bytes"),
        total("output_bytes").cast("bigint").alias("output_bytes"),
        F.coalesce(total("manifest_bytes"), F.lit(0)).cast("bigint").alias("manifest_bytes"),
        total("encode_seconds").alias("encode_seconds"),
        total("decode_seconds").alias("decode_seconds"),
        (F.max("peak_rss_bytes") if "peak_rss_bytes" in rows.columns else F.lit(None).cast("bigint")).alias("peak_rss_bytes"),
    )
    out = out.withColumns({"saving": V.saving("input_bytes", "output_bytes"), "encode_mib_s": V.throughput("input_bytes", "encode_seconds"), "decode_mib_s": V.throughput("input_bytes", "decode_seconds")})
    return out.join(states, list(by))


def failing_units(rows: DataFrame, *by: str) -> DataFrame:
    """The units whose trial failed or wasn't exact, as a table."""
    return rows.where(~((F.col("status") == "ok") & F.coalesce(F.col("exact"), F.lit(False)))).select(*by, "unit_id", "status")


def shard_gain(rolled: DataFrame) -> DataFrame:
    """Saving of shards less saving of single documents, by method, largest first."""
    a = rolled.where("mode = 'perdoc'").select("method", F.col("saving").alias("perdoc"))
    b = rolled.where("mode = 'shard'").select("method", F.col("saving").alias("shard"))
    return a.join(b, "method").withColumn("gain", F.col("shard") - F.col("perdoc")).orderBy(F.desc("gain"), "method")


def answers(rolled: DataFrame) -> DataFrame:
    """One row: the methods with the best saving, the fastest encoding and decoding, and the worst of each."""
    best = lambda c, pick, name: pick(F.struct("mode", "method", c), F.struct(F.col(c), "mode", "method")).alias(name)
    rows = rolled.where("good > 0")
    return rows.agg(
        best("saving", F.max_by, "best_saving"),
        best("saving", F.min_by, "least_saving"),
        best("encode_mib_s", F.max_by, "fastest_encode"),
        best("encode_mib_s", F.min_by, "slowest_encode"),
        best("decode_mib_s", F.max_by, "fastest_decode"),
        best("decode_mib_s", F.min_by, "slowest_decode"),
    )


def with_baseline(rolled: DataFrame) -> DataFrame:
    """``rolled`` below a row of no compression for each mode."""
    base = rolled.groupBy("mode").agg(F.max("input_bytes").alias("input_bytes")).select("mode", F.lit("none").alias("method"), "input_bytes", F.col("input_bytes").alias("output_bytes"), F.lit(0.0).alias("saving"))
    return base.unionByName(rolled, allowMissingColumns=True)
