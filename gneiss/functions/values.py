"""Numeric, array, map, JSON and hash expressions."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

MIB = 1024 * 1024
#: Edges of the size and page histograms: half-open bins [lo, hi).
SIZE_EDGES = (0, 10_000, 50_000, 100_000, 250_000, 500_000, 1_000_000, 2_500_000, 5_000_000, 10_000_000, 25_000_000, 50_000_000, 100_000_000, 1_000_000_000)
PAGE_EDGES = (0, 2, 5, 10, 25, 50, 100, 250, 500, 1000, 10_000)
#: Keys that don't belong to a scope's identity, and lists whose order doesn't matter.
VOLATILE = ("observed_at", "reported_total", "discovered_count")
UNORDERED = ("groups", "types", "catalog")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def finite(x: Column | str) -> Column:
    """Whether a number is neither null, NaN nor infinite."""
    v = _c(x).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def size_bucket(x: Column | str) -> Column:
    """small below 1 MiB, medium below 10 MiB, else large."""
    return F.when(_c(x) < MIB, "small").when(_c(x) < 10 * MIB, "medium").otherwise("large")


def page_bucket(x: Column | str) -> Column:
    """short up to 10 pages, medium up to 100, else long."""
    return F.when(_c(x) <= 10, "short").when(_c(x) <= 100, "medium").otherwise("long")


def bin_of(x: Column | str, edges=SIZE_EDGES) -> Column:
    """Number of the half-open bin that holds x, null outside."""
    out = F.lit(None).cast("int")
    for k in range(len(edges) - 2, -1, -1):
        out = F.when((_c(x) >= edges[k]) & (_c(x) < edges[k + 1]), k).otherwise(out)
    return out


def equal_bin(x: Column | str, lo: float, hi: float, bins: int = 40) -> Column:
    """Number of the equal-width bin; the last one is closed."""
    return F.least(F.floor((_c(x).cast("double") - lo) * bins / (hi - lo)), F.lit(bins - 1)).cast("int")


def page_class(coverage: Column | str, chars: Column | str) -> Column:
    """raster_text, born, raster, mixed or unknown, by image coverage and extracted characters."""
    cov, n = _c(coverage), _c(chars)
    return F.when((cov >= 0.70) & (n >= 20), "raster_text").when((n >= 20) & (cov < 0.05), "born").when((cov >= 0.70) & (n < 20), "raster").when((n >= 20) & (cov >= 0.05), "mixed").otherwise("unknown")


def page_rationale(coverage: Column | str, chars: Column | str, blocks: Column | str) -> Column:
    """Why a page has its class."""
    cov, n, b = _c(coverage), _c(chars), _c(blocks)
    kind = page_class(cov, n)
    return (
        F.when(kind == "raster_text", "dominant image with selectable text")
        .when(kind == "born", "text without notable images")
        .when(kind == "raster", "dominant image without text")
        .when(kind == "mixed", "text and images")
        .when((b > 0) | (cov > 0), "little text or small images")
        .otherwise("no text and no image")
    )


def saving(before: Column | str, after: Column | str) -> Column:
    """1 - after / before, null where before is zero."""
    return 1 - ratio(after, before)


def throughput(size: Column | str, seconds: Column | str) -> Column:
    """MiB per second, null for no time."""
    return ratio(_c(size) / float(MIB), seconds)


def label(x: Column | str) -> Column:
    """Sorted distinct values joined by slashes."""
    return F.array_join(F.array_sort(F.array_distinct(_c(x))), "/")


def filter_chain(filters: Column | str) -> Column:
    """Filters joined by +, or unfiltered."""
    return F.coalesce(F.nullif(F.array_join(_c(filters), "+"), F.lit("")), F.lit("unfiltered"))


def last_filter(filters: Column | str) -> Column:
    """The terminal filter, null without any."""
    return F.try_element_at(_c(filters), F.lit(-1))


def chunk_hashes(content: Column | str, size: int = 1024) -> Column:
    """Distinct SHA-256 hashes of the aligned chunks of a binary value."""
    b = _c(content)
    n = F.octet_length(b)
    starts = F.when(n > 0, F.sequence(F.lit(0), (F.ceil(n / size) - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.sha2(F.substring(b, i * size + 1, F.lit(size)), 256)))


def jaccard(a: Column | str, b: Column | str) -> Column:
    """Shared share of two sets; 1 for two empty ones."""
    union = F.size(F.array_union(_c(a), _c(b)))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(_c(a), _c(b))) / union)


def first_middle_last(pages: Column | str) -> Column:
    """Distinct page numbers of the first, the middle and the last page."""
    n = _c(pages).cast("int")
    return F.when(n > 0, F.array_distinct(F.array(F.lit(1), F.expr(f"{n._jc.toString()} div 2").cast("int") + 1, n))).otherwise(F.array().cast("array<int>"))


def canonical_json(**columns: Column) -> Column:
    """Compact JSON with sorted keys that keeps nulls."""
    return F.to_json(F.struct(*[columns[k].alias(k) for k in sorted(columns)]), {"ignoreNullFields": "false"})


def sha256(x: Column | str) -> Column:
    """Lower-case hex SHA-256 of a text or binary value."""
    return F.sha2(_c(x), 256)


def digest_list(items: Column, order: Column | None = None, separator: str = "|") -> Column:
    """SHA-256 of an aggregated list in order; an aggregate expression."""
    pairs = F.array_sort(F.collect_list(F.struct((items if order is None else order).alias("o"), items.alias("v"))))
    return F.sha2(F.array_join(F.transform(pairs, lambda p: p["v"]), separator), 256)


def merge_maps(*maps: Column) -> Column:
    """One map; later entries win."""
    entries = F.concat(*[F.map_entries(F.coalesce(m, F.create_map().cast("map<string,string>"))) for m in maps])
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(F.transform(keys, lambda k: F.struct(k.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"].alias("value"))))


def scope_fingerprint(scope: dict) -> str:
    """Identity of a discovery scope: SHA-256 of its canonical JSON without volatile keys, list order aside."""

    def stable(value, name=""):
        if isinstance(value, dict):
            return {k: stable(v, k) for k, v in sorted(value.items()) if k not in VOLATILE}
        if isinstance(value, list | tuple):
            out = [stable(v) for v in value]
            return sorted(out, key=lambda v: json.dumps(v, sort_keys=True)) if name in UNORDERED else out
        return value

    text = json.dumps(stable(scope), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return hashlib.sha256(text.encode()).hexdigest()
