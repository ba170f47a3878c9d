"""Exact redundancy of stored streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions import values as V
from gneiss.sources.sinks import reference_lines


def by_digest(objects: DataFrame, file: str, digest: str, size: str, *also: str) -> DataFrame:
    """Occurrences and files of each digest (and size, and further columns)."""
    rows = objects.where(F.col(digest).isNotNull())
    return rows.groupBy(*also, F.col(digest).alias("digest"), F.col(size).alias("bytes")).agg(F.count("*").alias("refs"), F.count_distinct(file).alias("files"))


def repeated_bytes(objects: DataFrame, file: str, digest: str, size: str, *by: str) -> DataFrame:
    """Bytes repeated inside files (intra), across files (cross) and altogether (potential)."""
    g = by_digest(objects, file, digest, size, *by)
    sums = [F.coalesce(F.sum(F.col("bytes") * e), F.lit(0)).cast("bigint").alias(n) for n, e in (("intra", F.col("refs") - F.col("files")), ("cross", F.col("files") - 1), ("potential", F.col("refs") - 1))]
    return g.groupBy(*by).agg(*sums) if by else g.agg(*sums)


def later_occurrences(objects: DataFrame, category: str, digest: str, *order: str) -> DataFrame:
    """All but the first occurrence in each category and digest."""
    w = Window.partitionBy(category, digest).orderBy(*order)
    return objects.where(F.col(digest).isNotNull()).withColumn("__n", F.row_number().over(w)).where("__n > 1").drop("__n")


def duplicate_summary(objects: DataFrame) -> DataFrame:
    """By category: repeated groups, occurrences beyond the first, intra, cross and gross bytes, bytes of reference lines, capacity.

    ``objects`` has category, encoded_sha256, bytes, document_sha256 and xref; empty streams don't count.
    """
    real = objects.where((F.col("bytes") > 0) & F.col("encoded_sha256").isNotNull())
    groups = real.groupBy("category", "encoded_sha256").agg(F.max("bytes").alias("size"), F.count("*").alias("refs"), F.count_distinct("document_sha256").alias("files")).where("refs > 1")
    sums = groups.groupBy("category").agg(
        F.count("*").alias("groups"),
        F.sum(F.col("refs") - 1).cast("bigint").alias("occurrences"),
        F.sum(F.col("size") * (F.col("refs") - F.col("files"))).cast("bigint").alias("intra"),
        F.sum(F.col("size") * (F.col("files") - 1)).cast("bigint").alias("cross"),
    )
    lines = reference_lines(later_occurrences(real, "category", "encoded_sha256", "document_sha256", "xref"))
    lines = lines.groupBy("category").agg(F.sum("line_bytes").cast("bigint").alias("reference_bytes"))
    out = sums.join(lines, "category", "left").withColumn("reference_bytes", F.coalesce("reference_bytes", F.lit(0).cast("bigint")))
    return out.withColumn("gross", F.col("intra") + F.col("cross")).withColumn("capacity", F.col("gross") - F.col("reference_bytes"))


def fingerprint_groups(df: DataFrame, fingerprint: str, file: str) -> DataFrame:
    """One row: fingerprints that occur again, and those that more than one file has."""
    g = df.where(F.col(fingerprint).isNotNull()).groupBy(fingerprint).agg(F.count("*").alias("n"), F.count_distinct(file).alias("files"))
    return g.agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("files") > 1).alias("across_files"))


def ambiguous_names(df: DataFrame, name: str, digest: str) -> DataFrame:
    """Names that stand for more than one payload."""
    return df.groupBy(name).agg(F.count_distinct(digest).alias("payloads"), F.count("*").alias("n")).where("payloads > 1")


def top_names(df: DataFrame, digest: str, size: str, name: str, top: int = 10, names: int = 5) -> DataFrame:
    """The digests with most bytes, with up to ``names`` of their names in order."""
    g = df.groupBy(digest).agg(F.sum(size).cast("bigint").alias("bytes"), F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set(name)), 1, names).alias("names"))
    return g.orderBy(F.desc("bytes"), digest).limit(top)


def first_of_each(df: DataFrame, group: str, digest: str, size: str, order: list[str], most: int, k: int = 3) -> DataFrame:
    """The first ``k`` distinct digests of each group whose size is from 1 to ``most``."""
    small = df.where(F.col(size).between(1, most))
    one = small.withColumn("__d", F.row_number().over(Window.partitionBy(group, digest).orderBy(*order))).where("__d = 1")
    return one.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k).drop("__d")


def pairs_of_largest(df: DataFrame, group: str, digest: str, size: str, top: int = 10, most: int = 1 << 20) -> DataFrame:
    """Of the groups with most bytes, the first two digests; pairs with a larger payload than ``most`` are left out."""
    largest = df.groupBy(group).agg(F.sum(size).cast("bigint").alias("total")).orderBy(F.desc("total"), group).limit(top)
    one = df.join(F.broadcast(largest), group).groupBy(group, "total", digest).agg(F.max(size).alias("size"))
    two = one.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(digest))).where("rank <= 2")
    pairs = two.groupBy(group, "total").agg(F.max(F.when(F.col("rank") == 1, F.col(digest))).alias("first"), F.max(F.when(F.col("rank") == 2, F.col(digest))).alias("second"), F.max("size").alias("largest"))
    return pairs.where(F.col("second").isNotNull() & (F.col("largest") <= most))


def font_similarity(fonts: DataFrame, name: str, digest: str, size: str, content: str, top: int = 10, most: int = 1 << 20) -> DataFrame:
    """Chunk similarity and size ratio of the first two payloads of names that stand for several payloads, largest names first.

    ``fonts`` has the payloads themselves (content); only those of the chosen pairs are read into chunks.
    """
    several = fonts.where(F.col(digest).isNotNull() & F.col(name).isNotNull())
    names = ambiguous_names(several, name, digest).select(name)
    pairs = pairs_of_largest(several.join(names, name, "left_semi"), name, digest, size, top, most)
    payload = several.groupBy(digest).agg(F.first(content).alias("content"))
    first = payload.select(F.col(digest).alias("first"), F.col("content").alias("a"))
    second = payload.select(F.col(digest).alias("second"), F.col("content").alias("b"))
    both = pairs.join(first, "first").join(second, "second")
    lengths = F.octet_length("a"), F.octet_length("b")
    return both.select(name, "first", "second", V.ratio(F.least(*lengths), F.greatest(*lengths)).alias("size_ratio"), V.jaccard(V.chunk_hashes("a"), V.chunk_hashes("b")).alias("chunk_jaccard"))
