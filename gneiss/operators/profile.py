"""Distributions, grouped metrics, histograms, ranking and samples of a corpus profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions import values as V
from gneiss.sources.workspace import ranged

PERCENTS = (10, 25, 50, 75, 90, 95, 99)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def distribution(x: Column | str, prefix: str = "") -> list[Column]:
    """Aggregates count, mean, median, stddev (of a population), min, max and p10..p99, linear between ranks, of finite numbers.

    All but the count are null where there is no number.
    """
    v = F.when(V.finite(x), _c(x).cast("double"))
    ranks = F.percentile(v, F.array(*[F.lit(p / 100) for p in (50, *PERCENTS)]))  # the same for all: sorted once
    at = lambda k: F.get(ranks, F.lit(k))
    out = [F.count(v).alias(f"{prefix}count"), F.avg(v).alias(f"{prefix}mean"), at(0).alias(f"{prefix}median"), F.stddev_pop(v).alias(f"{prefix}stddev"), F.min(v).alias(f"{prefix}min"), F.max(v).alias(f"{prefix}max")]
    return out + [at(k + 1).alias(f"{prefix}p{p}") for k, p in enumerate(PERCENTS)]


def distributions(df: DataFrame, x: str, *by: str) -> DataFrame:
    """The distribution of a column, for all rows or by columns."""
    return df.groupBy(*by).agg(*distribution(x)) if by else df.agg(*distribution(x))


def grouped_metrics(df: DataFrame, groups: list[str], sums: dict[str, str], of: dict[str, str]) -> DataFrame:
    """Rows, sums and distributions over all rows and over each grouping alone (grouping sets), in one pass.

    Columns: grouping (all or a column's name), value, rows, the sums, and the distributions by their prefix.
    """
    grouping = F.when(F.grouping_id() == 2 ** len(groups) - 1, "all")
    value = F.lit(None).cast("string")
    for g in reversed(groups):
        value = F.when(F.grouping(g) == 0, F.col(g).cast("string")).otherwise(value)
    for g in groups:
        grouping = grouping.when(F.grouping(g) == 0, g)
    metrics = [F.count("*").alias("rows"), *[F.sum(c).cast("bigint").alias(n) for n, c in sums.items()]]
    for prefix, c in of.items():
        metrics += distribution(c, prefix + "_")
    sets = [[F.col(g)] for g in groups]
    return df.groupingSets([[], *sets], *[F.col(g) for g in groups]).agg(grouping.alias("grouping"), value.alias("value"), *metrics).drop(*groups)


def floor_stats(df: DataFrame, x: str) -> DataFrame:
    """One row: count, mean, middle element of the sorted list (lower of two), element at the truncated 95 % index, max; zeros for no rows.

    The list is never gathered: counts by value are ranked, and the two elements are looked up.
    """
    counts = df.where(F.col(x).isNotNull()).groupBy(F.col(x).alias("v")).agg(F.count("*").alias("n"))
    # ranks need an order over all values: range partitions are summed first, then each ranks alone
    parts, offsets = ranged(counts, "v", amount=F.sum("n"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.coalesce(F.sum(F.col("v") * F.col("n")), F.lit(0)).alias("sum"), F.max("v").alias("max"))
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    ranked = parts.join(F.broadcast(offsets), "part").withColumn("upto", upto)
    at = ranked.join(F.broadcast(total)).agg(
        F.min(F.when(F.col("upto") > F.floor((F.col("count") - 1) / 2), F.col("v"))).alias("median"),
        F.min(F.when(F.col("upto") > F.floor((F.col("count") - 1) * 0.95), F.col("v"))).alias("p95"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return total.join(F.broadcast(at)).select(F.col("count").cast("bigint").alias("count"), F.coalesce(F.col("sum") / F.nullif("count", F.lit(0)), F.lit(0.0)).alias("mean"), zero("median"), zero("p95"), zero("max"))


def top_share(df: DataFrame, x: str, key: str, percents=(1, 5, 10)) -> DataFrame:
    """One row for each percent p: the share of the sum that the largest ceil(n * p / 100) rows hold.

    Only ranks up to the largest percent are needed, so the rows are cut by a threshold, and ranked by range partitions.
    """
    total = df.agg(F.count("*").alias("n"), F.sum(x).cast("double").alias("sum"))
    cut = df.agg(F.percentile_approx(x, F.lit(1 - max(percents) / 100 - 0.02), F.lit(10000)).alias("cut"))
    large = df.join(F.broadcast(cut)).where(F.col(x) >= F.coalesce("cut", F.col(x))).select(x, key)
    parts, offsets = ranged(large, F.desc(x), F.asc(key), amount=F.count("*"))
    ranked = parts.join(F.broadcast(offsets), "part").withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(F.desc(x), F.asc(key))))
    sums = ranked.join(F.broadcast(total)).groupBy("n", "sum").agg(*[F.sum(F.when(F.col("rank") <= F.ceil(F.col("n") * p / 100), F.col(x))).cast("double").alias(f"p{p}") for p in percents])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(p).alias("percent"), V.ratio(f"p{p}", "sum").alias("share")) for p in percents])))


def counts_by(df: DataFrame, *by: Column | str, sums: dict[str, str] | None = None) -> DataFrame:
    """A counter: rows (n) and sums for each value."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(c).cast("bigint").alias(a) for a, c in (sums or {}).items()])


def dominant(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent ones the one met first in ``order``, then the least."""
    counted = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col("first"), F.col(value))).alias(value))


def fractions(pages: DataFrame, key: str, flag: str, size: str) -> DataFrame:
    """Share of flagged pages and bytes a page of each key (no pages count as one)."""
    grouped = pages.groupBy(key).agg(F.count("*").alias("pages"), F.count_if(flag).alias("flagged"), F.sum(size).cast("bigint").alias("bytes"))
    return grouped.select(key, "pages", (F.col("flagged") / F.greatest(F.lit(1), "pages")).alias("fraction"), (F.col("bytes") / F.greatest(F.lit(1), "pages")).alias("bytes_per_page"))


def histogram(df: DataFrame, x: str, edges=V.SIZE_EDGES) -> DataFrame:
    """Rows in each half-open bin, empty bins too; values outside are left out."""
    spark = df.sparkSession
    bins = spark.createDataFrame([(k, float(edges[k]), float(edges[k + 1])) for k in range(len(edges) - 1)], "bin int, lo double, hi double")
    found = df.select(V.bin_of(x, edges).alias("bin")).where("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("n"))
    return bins.join(found, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def equal_histogram(df: DataFrame, x: str, bins: int = 40) -> DataFrame:
    """Rows in equal-width bins between the least and the largest value."""
    ends = df.agg(F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0))
    placed = df.where(F.col(x).isNotNull()).join(F.broadcast(ends)).select(F.least(F.floor((F.col(x).cast("double") - F.col("lo")) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    return placed.groupBy("bin").agg(F.count("*").alias("n"))


def outliers(files: DataFrame, size: str, key: str, reasons: list[tuple[str, Column]], fallback: str = "large file", top: int = 20) -> DataFrame:
    """The ``top`` largest rows with their rank and the reasons that hold, in order."""
    named = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in reasons]))
    chosen = files.orderBy(F.desc(size), F.asc(key)).limit(top)
    ranked = chosen.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(size), F.asc(key))))
    return ranked.withColumn("reasons", F.when(F.size(named) > 0, named).otherwise(F.array(F.lit(fallback))))


def stratified_sample(df: DataFrame, strata: list[str], key: str, k: int = 1, seed: int = 20261010) -> DataFrame:
    """``k`` rows of each stratum by a seeded hash of the key, with stratum_population."""
    rank = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256)
    hashed = df.withColumn("__h", rank)
    population = df.groupBy(*strata).agg(F.count("*").alias("stratum_population"))
    best = hashed.withColumn("__r", F.row_number().over(Window.partitionBy(*strata).orderBy("__h"))).where(F.col("__r") <= k)
    same = [F.col(f"a.{s}").eqNullSafe(F.col(f"b.{s}")) for s in strata]
    joined = best.alias("a").join(population.alias("b"), on=same)
    return joined.select("a.*", "b.stratum_population").drop("__h", "__r")


def percent_of_total(df: DataFrame, by: list[str], size: str, within: str | None = None) -> DataFrame:
    """Sums with their share of all and, if asked, of a class."""
    sums = df.groupBy(*by).agg(F.sum(size).cast("bigint").alias("bytes"))
    total = df.agg(F.sum(size).cast("double").alias("__all"))
    out = sums.join(F.broadcast(total)).withColumn("percent", V.ratio(F.col("bytes") * 100.0, "__all")).drop("__all")
    if within:
        part = df.groupBy(within).agg(F.sum(size).cast("double").alias("__part"))
        out = out.join(part, within).withColumn("percent_of_class", V.ratio(F.col("bytes") * 100.0, "__part")).drop("__part")
    return out


def health(files: DataFrame) -> DataFrame:
    """One row of corpus counters: profiled, successful, failed, encrypted, repaired, with warnings and metadata, slots, bytes, seconds."""
    ok = F.col("status") == "ok"
    return files.agg(
        F.count("*").alias("profiled"),
        F.count_if(ok).alias("successful"),
        F.count_if(~ok).alias("failed"),
        F.count_if(ok & F.col("encrypted")).alias("encrypted"),
        F.count_if(ok & F.col("repaired")).alias("repaired"),
        F.count_if(ok & (F.size("warnings") > 0)).alias("with_warnings"),
        F.count_if(ok & (F.size("metadata") > 0)).alias("with_metadata"),
        F.coalesce(F.sum(F.when(ok, F.col("xref_unresolved"))), F.lit(0)).cast("bigint").alias("unresolved_slots"),
        F.coalesce(F.sum(F.when(ok, F.col("residual_file_bytes"))), F.lit(0)).cast("bigint").alias("residual_bytes"),
        F.coalesce(F.sum("profile_seconds"), F.lit(0.0)).alias("seconds"),
    )


def failed_files(files: DataFrame) -> DataFrame:
    """The files that failed, with their errors."""
    return files.where(F.col("status") != "ok").select("sha256", "error")


def tag_counts(df: DataFrame, tags: str) -> DataFrame:
    """How often each tag of an array column occurs."""
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))
