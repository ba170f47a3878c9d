"""URL filter: rules first, then gradient-boosted trees on lexical features; built-in functions only.

A rule names a host and a path; it fits the host and its subdomains where the url's path starts with
the rule's, and the longest rule wins.  The rows that a rule decides are the labelled urls.  Features
are binned; labelled rows are counted by their bins, and each tree (depth two, Newton steps on the
logistic loss) is grown from sums of gradients over these counts, a few hundred rows a level.  Scoring
is one expression over the bins.

The rates of blocked urls under a host's last label and under a path's first segment are features;
each labelled value has its smoothed rate in a table that is joined, and others take the overall rate.

Defined results: a null url, or one without ://, has an empty host and path, fits no rule and gets
the method's verdict on its features; without any labelled url the method allows; of splits that gain
equally the first feature's lowest bin is taken; equal rows give equal rows; an empty table gives no rows; other columns don't matter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.storage import materialize

#: (verdict, rule) as the query uses them.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
TREES, RATE = 10, 0.4


def host_path(url: str = "url") -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of the url column; empty without ://."""
    part = lambda pattern: F.coalesce(F.regexp_extract(F.col(url).cast("string"), pattern, 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(part(r"(?s)^.*?://([^/?#]*)"), upper, upper.lower()), part(r"(?s)^.*?://[^/?#]*([^?#]*)")


def apply_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and ruled (the rule's verdict)."""
    host, path = host_path()
    out = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, name in sorted(rules, key=lambda r: len(r[1])):  # a longer rule overrides
        own, _, rest = name.partition("/")
        fits = ((F.col("host") == own) | F.col("host").endswith("." + own)) & F.col("path").startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return out.withColumns({"rule": rule, "ruled": verdict})


def _entropy(x: str) -> str:
    """Bits per character of the text, over all characters that it has."""
    share = f"((length({x}) - length(replace({x}, c, ''))) / length({x}))"
    return f"aggregate(array_distinct(split({x}, '')), 0D, (a, c) -> IF(c = '', a, a - {share} * log2({share})))"


#: Feature -> (SQL over url, lower, host, path, rate; upper edges of its bins but the last).
FEATURES: dict[str, tuple[str, list[float]]] = {
    "length": ("length(__url)", [20, 28, 32, 36, 40, 44, 48, 56, 64, 80, 120, 200]),
    "depth": ("length(path) - length(replace(path, '/', ''))", [0, 1, 2, 3, 4, 6, 9]),
    "digits": ("length(regexp_replace(__url, '[^0-9]', '')) / greatest(length(__url), 1)", [0.0, 0.02, 0.05, 0.08, 0.12, 0.2, 0.35]),
    "entropy": (_entropy("__lower"), [2.5, 3.0, 3.25, 3.5, 3.75, 4.0, 4.25, 4.5, 4.75]),
    "parameters": ("IF(contains(__url, '?'), 1 + length(__url) - length(replace(__url, '&', '')), 0)", [0, 1, 2, 3, 4, 5, 8]),
    "labels": ("length(host) - length(replace(host, '.', ''))", [0, 1, 2, 3, 4]),
    "hyphens": ("length(host) - length(replace(host, '-', ''))", [0, 1, 2]),
    "host_length": ("length(host)", [8, 14, 16, 18, 20, 22, 24, 28, 36]),
    "first": ("length(regexp_extract(path, '^/([^/]*)', 1))", [0, 1, 2, 3, 5, 8, 12]),
    "suffix_length": ("length(substring_index(host, '.', -1))", [0, 2, 3, 4, 6]),
    "suffix_rate": ("__suffix_rate", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]),
    "section_rate": ("__section_rate", [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]),
}
#: Values whose rates of blocked urls are features.
RATED = {"suffix": "substring_index(host, '.', -1)", "section": "regexp_extract(path, '^/([^/]*)', 1)"}


@dataclass
class Model:
    """Trees as ((feature, bin), ((feature, bin, low value, high value) of the low side, of the high side)); a table (value, rate) for each of RATED."""

    base: float
    trees: list
    rates: dict[str, DataFrame]
    rate: float


def _bins(ruled: DataFrame, rates: dict[str, DataFrame], rate: float) -> DataFrame:
    """``ruled`` with __bins, an array of a small number for each feature."""
    out = ruled.withColumn("__url", F.coalesce(F.col("url").cast("string"), F.lit(""))).withColumn("__lower", F.lower("__url"))
    for name, sql in RATED.items():
        known = F.lit(float(rate))
        if name in rates:
            own = rates[name].select(F.col("value").alias(f"__{name}"), F.col("rate").alias("__own"))
            out = out.withColumn(f"__{name}", F.expr(sql)).join(own, f"__{name}", "left")
            known = F.coalesce("__own", known)
        out = out.withColumn(f"__{name}_rate", known).drop(f"__{name}", "__own")
    values = {f"__v_{name}": F.expr(sql).cast("double") for name, (sql, _) in FEATURES.items()}
    out = out.withColumns(values)
    bins = [F.expr(f"CASE {' '.join(f'WHEN `__v_{name}` <= {float(e)}D THEN {i}' for i, e in enumerate(edges))} ELSE {len(edges)} END") for name, (_, edges) in FEATURES.items()]
    return out.withColumn("__bins", F.array(*bins)).drop(*values, "__url", "__lower", *(f"__{name}_rate" for name in RATED))


def _tree(tree) -> str:
    (f, b), sides = tree
    leaf = lambda s: f"IF(__bins[{s[0]}] <= {s[1]}, {s[2]!r}D, {s[3]!r}D)" if s[0] is not None else f"{s[2]!r}D"
    return f"IF(__bins[{f}] <= {b}, {leaf(sides[0])}, {leaf(sides[1])})"


def margin(model: Model) -> Column:
    """The log-odds of block for a row with __bins."""
    return F.expr(" + ".join([f"{model.base!r}D", *map(_tree, model.trees)]))


def best_split(sums: dict[tuple[int, int], tuple[float, float]], total: tuple[float, float], ridge: float = 1.0):
    """(gain, feature, bin) of the best split of gradient and curvature sums by (feature, bin)."""
    best = (0.0, None, None)
    score = lambda g, h: g * g / (h + ridge)
    for f in sorted({k for k, _ in sums}):
        g = h = 0.0
        for b in range(len(list(FEATURES.values())[f][1])):
            x = sums.get((f, b), (0.0, 0.0))
            g, h = g + x[0], h + x[1]
            gain = score(g, h) + score(total[0] - g, total[1] - h) - score(*total)
            if gain > best[0] + 1e-9:
                best = (gain, f, b)
    return best


def train(ruled: DataFrame, trees: int = TREES, rate: float = RATE) -> Model:
    """Boosted trees from all rows of ``apply_rules`` that a rule decided."""
    labelled = ruled.where("ruled IS NOT NULL").select("url", "host", "path", (F.col("ruled") == "block").cast("double").alias("__y"))
    totals = labelled.agg(F.sum("__y"), F.count("*")).first()
    if not totals[1]:
        return Model(-1.0, [], {}, 0.0)
    share = (totals[0] + 1) / (totals[1] + 2)
    rates = {}
    for name, sql in RATED.items():
        counted = labelled.groupBy(F.expr(sql).alias("value")).agg(F.sum("__y").alias("y"), F.count("*").alias("n"))
        rates[name] = materialize(counted.select("value", ((F.col("y") + 10 * share) / (F.col("n") + 10)).alias("rate")), name)
    cells = materialize(_bins(labelled, rates, share).groupBy("__bins").agg(F.sum("__y").alias("y"), F.count("*").cast("double").alias("n")), "cells")
    model = Model(math.log(share / (1 - share)), [], rates, share)
    for _ in range(trees):
        p = 1 / (1 + F.exp(-margin(model)))
        steps = cells.select("__bins", (F.col("y") - p * F.col("n")).alias("g"), (p * (1 - p) * F.col("n")).alias("h"))

        def sums(frame: DataFrame, *by: str) -> list:
            each = frame.select(*by, F.posexplode("__bins").alias("f", "b"), "g", "h")
            return each.groupBy(*by, "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()

        def split(rows) -> tuple:
            own = {(f, b): (g, h) for f, b, g, h in rows}
            total = tuple(sum(x[i] for (f, _), x in own.items() if f == 0) for i in (0, 1))
            return own, total, best_split(own, total)

        value = lambda g, h: rate * g / (h + 1.0)
        _, total, (gain, f, b) = split(sums(steps))
        if f is None:
            break
        halves = sums(steps.withColumn("side", F.expr(f"IF(__bins[{f}] <= {b}, 0, 1)")), "side")
        sides = []
        for side in (0, 1):
            own, total, (gain, f2, b2) = split([r[1:] for r in halves if r[0] == side])
            if f2 is None:
                sides.append((None, None, value(*total), value(*total)))
            else:
                low = [sum(own.get((f2, k), (0.0, 0.0))[i] for k in range(b2 + 1)) for i in (0, 1)]
                sides.append((f2, b2, value(*low), value(total[0] - low[0], total[1] - low[1])))
        model.trees.append(((f, b), tuple(sides)))
    return model


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (the method's probability of block)."""
    ruled = apply_rules(pages, rules)
    model = train(ruled.select("url", "host", "path", "ruled"))
    scored = _bins(ruled, model.rates, model.rate).withColumn("score", 1 / (1 + F.exp(-margin(model))))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict).drop("__bins", "ruled")
