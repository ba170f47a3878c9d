"""Data quality: payloads, stored bytes, pagination, receipts and set equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.functions import text as T
from gneiss.sources.workspace import ranged


def payload_reason(content: Column, declared: Column, expected: Column) -> Column:
    """Why a payload is invalid, null if it isn't; the first rule that fails."""
    found = T.mime(content, declared)
    tail = F.decode(F.substring(content, -4096, 4096), "ISO-8859-1")
    pdf = expected == "application/pdf"
    return (
        F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, "empty_payload")
        .when(pdf & ~F.startswith(content, F.lit(b"%PDF-")), "missing_pdf_signature")
        .when(pdf & ~F.contains(tail, F.lit("%%EOF")), "missing_pdf_eof")
        .when(expected.isNotNull() & (found != expected), F.concat(F.lit("mime_mismatch:"), found))
    )


def validate(payloads: DataFrame) -> DataFrame:
    """``payloads`` (content, content_type, expected) with detected, reason and valid."""
    reason = payload_reason(F.col("content"), F.col("content_type"), F.col("expected"))
    return payloads.withColumns({"detected": T.mime("content", "content_type"), "reason": reason}).withColumn("valid", F.col("reason").isNull())


def verify_objects(objects: DataFrame, stored: DataFrame) -> DataFrame:
    """Registered objects against stored ones (sha256, content): state ok, missing or bad for each."""
    held = stored.groupBy("sha256").agg(F.max(F.sha2("content", 256) == F.col("sha256")).alias("sound"), F.max(F.octet_length("content")).alias("bytes"))
    state = F.when(F.col("sound").isNull(), "missing").when(F.col("sound"), "ok").otherwise("bad")
    return objects.join(held, "sha256", "left").withColumn("state", state)


def verify_summary(verified: DataFrame) -> DataFrame:
    """One row: checked, ok, missing, bad."""
    return verified.agg(F.count("*").alias("checked"), *[F.count_if(F.col("state") == s).alias(s) for s in ("ok", "missing", "bad")])


def revalidate(manifest: DataFrame, stored: DataFrame) -> DataFrame:
    """Manifest files whose size or hash no longer holds, or that are gone."""
    facts = stored.select("path", F.octet_length("content").cast("bigint").alias("found_size"), F.sha2("content", 256).alias("found_sha256"))
    joined = manifest.join(facts, "path", "left")
    wrong = F.when(F.col("found_size").isNull(), "missing").when(F.col("found_size") != F.col("logical_size"), "size").when(F.col("found_sha256") != F.col("sha256"), "sha256")
    return joined.withColumn("failure", wrong).where("failure IS NOT NULL")


def can_freeze(partitions: DataFrame) -> DataFrame:
    """One row by run: whether it has a partition and none is incomplete."""
    return partitions.groupBy("run_id").agg((F.count_if(F.col("status") != "complete") == 0).alias("can_freeze"), F.count("*").alias("partitions"))


def require_open(run: DataFrame) -> None:
    """Raises if a run is frozen."""
    if run.where("frozen_at IS NOT NULL").limit(1).count():
        raise ValueError("a frozen run takes no new items")


def page_errors(pages: DataFrame) -> DataFrame:
    """Fail-closed pagination: parsed pages of each partition in order, with the first error that holds.

    ``pages`` has run_id, group, type_id, year, page, ids, parser_ok, has_more and reported_total.
    """
    parts = Window.partitionBy("run_id", "group", "type_id", "year").orderBy("page")
    signed = pages.withColumn("signature", F.sha2(F.to_json("ids"), 256))
    before = F.lag("signature").over(parts)
    error = (
        F.when(~F.coalesce(F.col("parser_ok"), F.lit(False)), "page not recognised")
        .when((F.size("ids") > 0) & (F.col("signature") == before), "page repeats the one before")
        .when(F.col("has_more").isNull(), "end of results unknown")
        .when((F.size("ids") == 0) & (F.coalesce("reported_total", F.lit(-1)) != 0), "unexpected empty page")
    )
    return signed.withColumn("error", error)


def receipt_failures(expected: DataFrame, rows: DataFrame) -> DataFrame:
    """Benchmark rows against expected units (mode, method, unit_id, input_bytes, members): every unit with its problems.

    Problems: missing, duplicate, unexpected, and mismatch where a row's facts differ.
    """
    keys = ["mode", "method", "unit_id"]
    seen = rows.groupBy(*keys).agg(F.count("*").alias("seen"), F.first(F.struct(*[c for c in rows.columns if c not in keys])).alias("r"))
    joined = expected.withColumn("__expected", F.lit(True)).join(seen, keys, "full_outer")
    bad = (
        (F.col("r.status") != "ok")
        | ~F.coalesce(F.col("r.exact"), F.lit(False))
        | (F.col("r.input_bytes") != F.col("input_bytes"))
        | (F.col("r.output_bytes") != F.col("r.payload_bytes") + F.col("r.manifest_bytes"))
        | (F.col("r.independent_access") != (F.col("mode") == "perdoc"))
        | (F.col("r.member_sha256") != F.col("members"))
    )
    problems = F.array_compact(
        F.array(
            F.when(F.col("seen").isNull(), "missing"),
            F.when(F.col("seen") > 1, "duplicate"),
            F.when(F.col("__expected").isNull(), "unexpected"),
            F.when(F.col("__expected") & F.col("seen").isNotNull() & F.coalesce(bad, F.lit(True)), "mismatch"),
        )
    )
    return joined.select(*keys, problems.alias("problems"))


def full_coverage(failures: DataFrame) -> DataFrame:
    """One row: units, failing units, and whether none fails."""
    return failures.agg(F.count("*").alias("units"), F.count_if(F.size("problems") > 0).alias("failing")).withColumn("full_coverage", F.col("failing") == 0)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two tables has (with multiplicity), by side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def equal_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: whether two tables have the same rows."""
    return difference(a, b).agg((F.count("*") == 0).alias("equal"))


def sample_problems(sample: DataFrame, population: DataFrame) -> DataFrame:
    """Sampled rows that are repeated, unknown, or differ from the population in size (sha256, logical_size)."""
    counted = sample.groupBy("sha256").agg(F.count("*").alias("n"), F.max("logical_size").alias("size"))
    joined = counted.join(population.select("sha256", "logical_size"), "sha256", "left")
    problem = F.when(F.col("n") > 1, "duplicate").when(F.col("logical_size").isNull(), "unknown").when(F.col("size") != F.col("logical_size"), "size")
    return joined.withColumn("problem", problem).where("problem IS NOT NULL").select("sha256", "problem")


def within_budget(items: DataFrame, order: str, size: str, budget: int) -> DataFrame:
    """``items`` with the running size by ``order`` and whether it stays within the budget.

    Running sums of range partitions are added to sums of their own rows: no task holds all rows.
    """
    parts, sums = ranged(items, F.col(order), amount=F.sum(size), part="__part", before="__before")
    running = F.col("__before") + F.sum(size).over(Window.partitionBy("__part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return parts.join(F.broadcast(sums), "__part").withColumn("running", running.cast("bigint")).withColumn("fits", F.col("running") <= budget).drop("__part", "__before")


def reconcile(a: DataFrame, b: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Two one-row totals (total): both, their difference and whether they agree."""
    joined = a.select(F.col("total").alias("left_total")).join(b.select(F.col("total").alias("right_total")))
    gap = F.col("left_total") - F.col("right_total")
    return joined.withColumn("gap", gap).withColumn("agree", F.abs(gap) <= tolerance)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def same_identity(a: dict, b: dict, *names: str) -> None:
    """Raises if two receipts differ in the named facts."""
    wrong = [n for n in names if a.get(n) != b.get(n)]
    if wrong:
        raise ValueError("evidence of another run: " + ", ".join(f"{n} is {a.get(n)!r} and {b.get(n)!r}" for n in wrong))
