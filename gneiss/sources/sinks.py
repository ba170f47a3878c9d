"""Writers: content-addressed objects, Parquet exports, JSON lines, CSV, receipts and quarantine."""

from __future__ import annotations

import json
import os
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.functions.values import canonical_json

#: MIME types that are stored compressed.
COMPRESSED = ("text/html", "application/json", "text/plain")


def prepare_objects(payloads: DataFrame) -> DataFrame:
    """Distinct objects of (content, content_type): sha256, mime_type, logical_size, compression, path, content.

    Compressed objects hold a gzip stream without a time, so equal contents give equal files.
    """
    kind = T.mime("content", "content_type")
    rows = payloads.select(F.sha2("content", 256).alias("sha256"), kind.alias("mime_type"), F.octet_length("content").cast("bigint").alias("logical_size"), "content")
    rows = rows.dropDuplicates(["sha256"]).withColumn("compression", F.when(F.col("mime_type").isin(*COMPRESSED), "gzip"))
    rows = rows.withColumn("path", T.object_path("sha256", "mime_type", F.col("compression").isNotNull()))
    return rows


def gzip(df: DataFrame, content: str = "content", compression: str = "compression") -> DataFrame:
    """``df`` with contents compressed where ``compression`` is gzip, and stored_size."""
    at, how = df.columns.index(content), df.columns.index(compression)

    def run(batches):
        for batch in batches:
            out = []
            for value, kind in zip(batch.column(at).to_pylist(), batch.column(how).to_pylist(), strict=True):
                if kind == "gzip" and value is not None:
                    packer = zlib.compressobj(9, zlib.DEFLATED, 31)  # a gzip header without name and time
                    value = packer.compress(value) + packer.flush()
                out.append(value)
            columns = [pa.array(out, pa.binary()) if i == at else c for i, c in enumerate(batch.columns)]
            size = pa.array([None if v is None else len(v) for v in out], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, size], [*batch.schema.names, "stored_size"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, fields + ", stored_size bigint")


def store(payloads: DataFrame, known: DataFrame) -> DataFrame:
    """Objects to be written: those of ``payloads`` that ``known`` (sha256) hasn't, compressed; was_new tells on reading back."""
    return gzip(prepare_objects(payloads).join(known.select("sha256"), "sha256", "left_anti"))


def write_objects(objects: DataFrame, path: str) -> None:
    """Objects as Parquet, by the first byte of their hash; a re-run adds nothing that is there."""
    objects.withColumn("sha_prefix", F.substring("sha256", 1, 2)).write.mode("append").partitionBy("sha_prefix").parquet(path)


def verify_written(objects: DataFrame) -> DataFrame:
    """Objects whose content, unpacked, doesn't hash to their key."""
    from gneiss.sources.readers import gunzip

    return gunzip(objects).where(F.coalesce(F.sha2("content", 256) != F.col("sha256"), F.lit(True))).drop("content")


def export_parquet(parts: list[DataFrame], path: str | None = None) -> DataFrame:
    """One table of several with all their columns, numbers widened and nested values as JSON; zstd when written."""
    out = None
    widths = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, "float": 4, "double": 5}
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for name, kind in p.dtypes:
            kinds.setdefault(name, set()).add(kind)
    for p in parts:
        columns = []
        for name, kind in p.dtypes:
            c = F.col(f"`{name}`")
            if kind.startswith(("struct", "array", "map")):
                c = F.to_json(c, {"ignoreNullFields": "false"})
            elif len(kinds[name]) > 1 and all(k in widths for k in kinds[name]):
                widest = max(kinds[name], key=widths.get)
                c = c.cast("double" if widths[widest] > 3 else widest)
            elif len(kinds[name]) > 1:
                c = c.cast("string")
            columns.append(c.alias(name))
        p = p.select(*columns)
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    if path:
        out.write.option("compression", "zstd").parquet(path)
    return out


def write_json(value, path: str) -> None:
    """A small JSON file with sorted keys, written aside and then moved in place."""
    with open(path + ".part", "w", encoding="utf-8") as f:
        json.dump(value, f, sort_keys=True, indent=2, ensure_ascii=False)
        f.flush()
        os.fsync(f.fileno())
    os.replace(path + ".part", path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; nested columns as JSON."""
    flat = [F.to_json(F.col(n)).alias(n) if k.startswith(("struct", "array", "map")) else F.col(n) for n, k in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_jsonl(df: DataFrame, path: str) -> None:
    """Canonical JSON lines."""
    df.select(canonical_json(**{c: F.col(c) for c in df.columns}).alias("value")).write.mode("overwrite").text(path)


def reference_lines(later: DataFrame) -> DataFrame:
    """A canonical JSON line, with its size in bytes and line feed, for each repeated stream.

    ``later`` has document_sha256, xref, encoded_sha256 and bytes.
    """
    line = canonical_json(**{c: F.col(c) for c in ("bytes", "document_sha256", "encoded_sha256", "xref")})
    return later.select("*", line.alias("line")).withColumn("line_bytes", (F.octet_length("line") + 1).cast("bigint"))


def unrecorded(receipts: DataFrame, objects: DataFrame) -> DataFrame:
    """Receipts of stores that the registry hasn't: what a restart replays."""
    return receipts.join(objects.select("sha256"), "sha256", "left_anti")


def quarantine(pages: DataFrame) -> DataFrame:
    """Parsed pages that can't be trusted: not recognised, or without a known end."""
    return pages.where(~F.coalesce(F.col("parser_ok"), F.lit(False)) | F.col("has_more").isNull())


def markdown(df: DataFrame, most: int = 10_000) -> str:
    """A small report table as Markdown; pipes are escaped and line feeds become spaces; more than ``most`` rows are an error."""
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    held = df.limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} rows are no report table")
    rows = [df.columns, ["---"] * len(df.columns), *held]
    return "\n".join("| " + " | ".join(map(cell, r)) + " |" for r in rows)
