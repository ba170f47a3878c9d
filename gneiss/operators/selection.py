"""Sequential selections on small candidate sets: coverage of targets, and audits by groups.

Every step depends on what was chosen before, so these run in one task, on candidates that windows have
cut beforehand to as many as the steps can ever look at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The tags that a selection shows, in order, and then the types by their sizes.
TAGS = ("diagram_candidate", "little_extracted_text", "numeric_table_candidate", "table_candidate", "article", "paragraph_number", "raster_selectable_text", "numbers")
STRATA = tuple(f"{kind}/{size}" for kind in ("PMK", "PP") for size in ("small", "medium", "large"))


def _first(rows: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__n") <= most).drop("__n")


def cover(pages: DataFrame, size: int, tags=TAGS, strata=STRATA) -> DataFrame:
    """(sha256, page_number, target): a page for each tag, then for each stratum, then of documents in order, up to ``size``.

    ``pages`` has sha256, page_number, stratum (type, year, size) and tags.  Each target takes a page that isn't
    taken yet, whatever those before it have shown; a page of a document that isn't used yet comes first, then the
    least (sha256, page_number).  What is left is filled with the first pages of unused documents (target null).
    """
    if size < 1:
        raise ValueError("a selection has one page at least")
    steps = [*tags, *strata]
    own = F.concat(F.array_intersect("tags", F.array(*[F.lit(t) for t in tags])), F.array(F.concat_ws("/", F.get("stratum", F.lit(0)), F.get("stratum", F.lit(2)))))
    named = pages.select("sha256", F.col("page_number").cast("int").alias("page_number"), F.explode(own).alias("target")).where(F.col("target").isin(*steps))
    # at most ``size`` pages or documents are taken before a step, so it needs one more than these
    page = _first(named, ["target"], ["sha256", "page_number"], size + 1)
    document = _first(named.groupBy("target", "sha256").agg(F.min("page_number").alias("page_number")), ["target"], ["sha256"], size + 1)
    rest = pages.groupBy("sha256").agg(F.min("page_number").cast("int").alias("page_number")).orderBy("sha256").limit(2 * size).withColumn("target", F.lit(None).cast("string"))
    near = page.unionByName(document.select(*page.columns)).distinct().unionByName(rest.select(*page.columns))

    def run(key, table):
        queue: dict[str | None, list[tuple[str, int]]] = {}
        for r in sorted(table.to_pylist(), key=lambda r: (r["sha256"], r["page_number"])):
            queue.setdefault(r["target"], []).append((r["sha256"], r["page_number"]))
        out: dict[tuple[str, int], str | None] = {}
        for step in [*steps, *[None] * size]:
            used = {sha for sha, _ in out}
            free = [p for p in queue.get(step, []) if p not in out]
            fresh = [p for p in free if p[0] not in used]
            take = fresh or (free if step else [])
            if take and len(out) < size:
                out[take[0]] = step
        rows = [{"sha256": sha, "page_number": n, "target": step} for (sha, n), step in out.items()]
        return pa.Table.from_pylist(rows, pa.schema([("sha256", pa.string()), ("page_number", pa.int32()), ("target", pa.string())]))

    return near.groupBy(F.lit(1).alias("one")).applyInArrow(run, "sha256 string, page_number int, target string")


def by_groups(pages: DataFrame, most: int) -> DataFrame:
    """``most`` pages for an audit (class_name, audit_group, sha256, page_number, place): the groups in order, no document twice.

    Each group (class_name, audit_group) gives the first pages of as many documents as an even share of ``most``
    allows, one at least, that no group before it gave; the list is cut at ``most``.
    """
    keys = ["class_name", "audit_group"]
    one = pages.groupBy(*keys, "sha256").agg(F.min("page_number").cast("int").alias("page_number"))
    groups = one.select(*keys).distinct().count()
    quota = max(1, most // max(1, groups))
    near = _first(one, keys, ["sha256"], quota * max(1, groups))  # no more documents than that are given in all

    def run(key, table):
        rows, seen, given = sorted(table.to_pylist(), key=lambda r: (r["class_name"], r["audit_group"], r["sha256"])), set(), {}
        for r in rows:
            group = given.setdefault((r["class_name"], r["audit_group"]), [])
            if len(group) < quota and r["sha256"] not in seen:
                seen.add(r["sha256"])
                group.append(r)
        chosen = [r for group in given.values() for r in group][:most]
        return pa.Table.from_pylist([r | {"place": k} for k, r in enumerate(chosen)], pa.schema([("class_name", pa.string()), ("audit_group", pa.string()), ("sha256", pa.string()), ("page_number", pa.int32()), ("place", pa.int32())]))

    return near.groupBy(F.lit(1).alias("one")).applyInArrow(run, "class_name string, audit_group string, sha256 string, page_number int, place int")


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key by an order: a distinct union that keeps who came first."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__n = 1").drop("__n")


def audit_pages(files: DataFrame, sha: str, pages: str) -> DataFrame:
    """First, middle and last page of each file."""
    from gneiss.functions.values import first_middle_last

    return files.select(sha, F.explode(first_middle_last(pages)).alias("page_number"))
