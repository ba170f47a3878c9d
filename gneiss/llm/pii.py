"""Personal data by weak supervision, in built-in DataFrame functions only.

Base spans come from four patterns and their checks (parts of an address, Luhn sums, digits of a
phone number); they always stay.  Other candidate spans (long tokens with digits, digit groups,
titled names, handles) get votes of five labelers: the shape of the span, two gazetteers, the
context before it, and its mix of characters.  Expectation-maximisation over the counts of vote
patterns estimates each labeler's reliability and each pattern's probability; a logistic classifier
of span features is trained on these probabilities and decides which candidates are added.

Only counts of vote and feature patterns reach the driver; their number is bounded by the labelers
and the bins (3^5 votes times 768 feature patterns).  Positions are code points, ends exclusive: the pieces
between matches and the matches themselves are measured, so no function per row is needed.  The
patterns are the contract's, written so that a run of characters is scanned once: a match can only
begin where its run begins or where the last match ended.

Defined results: null texts are empty and have no spans; equal rows give equal rows; an empty table
gives no rows and no classifier is needed; ``redact`` keeps all columns, other columns don't matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gneiss.llm.storage import fence, materialize, shielded

#: kind -> pattern, in the order of the contract, then those that the method adds.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+",
    "number": r"(?<![0-9A-Za-z.+-])[0-9]{2,4}(?:[ .-][0-9]{2,5}){2,4}(?![0-9A-Za-z])",
    "name": r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra)\.? \p{Lu}\p{L}++(?: \p{Lu}\p{L}++)?+",
    "handle": r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{3,30}+(?![@.A-Za-z0-9])",
}
KINDS = [*BASE, *ADDED]
_TITLE = r"(Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sr|Sra)\.? "
CONTEXT = 32


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str, m: str) -> str:
    """SQL condition on a match ``m``."""
    if kind == "ip":
        return f"NOT {m} RLIKE {_sql(r'(^|[.])0*+([3-9][0-9]{2}|2[6-9][0-9]|25[6-9]|[1-9][0-9]{3,}+)([.]|$)')}"
    if kind == "card":
        d = f"reverse(regexp_replace({m}, '[^0-9]', ''))"
        luhn = f"aggregate(split({d}, ''), struct(0 AS s, 0 AS i), (a, c) -> IF(c = '', a, struct(a.s + IF(a.i % 2 = 0, int(c), IF(int(c) > 4, 2 * int(c) - 9, 2 * int(c))) AS s, a.i + 1 AS i))).s"
        return f"length({d}) BETWEEN 12 AND 19 AND {luhn} % 10 = 0"
    if kind == "phone":
        return f"length(regexp_replace({m}, '[^0-9]', '')) BETWEEN 9 AND 15"
    return "true"


#: Labelers: name -> SQL over a candidate x (kind, m: its text, l: text before, r: text behind); 1, -1 or 0 (no vote).
LABELERS = {
    "shape": f"""CASE WHEN x.m RLIKE {_sql(r"^(AKIA[A-Z0-9]{12,20}|[0-9a-f]{16,64}|[A-Za-z0-9+/_-]{24,})$")} OR x.kind IN ('name', 'handle')
                      OR x.m RLIKE {_sql(r"^[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}$|^[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$")} THEN 1
                 WHEN x.m RLIKE {_sql(r"^[0-9]{1,2}[ .-][0-9]{1,2}[ .-][0-9]{2,4}$|^(19|20)[0-9]{2}-|^[A-Za-z]+-?[0-9]{1,2}$")} THEN -1 ELSE 0 END""",
    "known": f"CASE WHEN x.m RLIKE {_sql(r'^(AKIA|ASIA|ghp_|gho_|sk-|pk-|xox|AIza|eyJ)')} THEN 1 WHEN x.m RLIKE {_sql(r'(?i)(version|utf|iso|http|sha256|base64|page)')} THEN -1 ELSE 0 END",
    "cue": f"""CASE WHEN x.l RLIKE {_sql(r'''(?i)(pass(word|wd|phrase)?|pwd|token|secret|api[ _-]?key|key|auth|ssn|social security|passport|account|tel|phone|call|mobile|contact|iban)[\x20"'=:]*$''')} OR x.m RLIKE {_sql(r'(?i)^(password|token|secret|key)')} THEN 1
                 WHEN x.l RLIKE {_sql(r'(?i)(version|isbn|page|chapter|section|figure|license|v|§|no[.])[\x20]*$')} THEN -1 ELSE 0 END""",
    "mix": f"""CASE WHEN x.kind IN ('name', 'handle') THEN 0 WHEN 4 * length(regexp_replace(x.m, '[^0-9]', '')) >= length(x.m) AND size(array_distinct(split(x.m, ''))) >= 8 THEN 1
                 WHEN 8 * length(regexp_replace(x.m, '[^0-9]', '')) < length(x.m) THEN -1 ELSE 0 END""",
    "behind": f"CASE WHEN x.r RLIKE {_sql(r'''^["'][\x20.,;]?''')} AND x.l RLIKE {_sql(r'''["']$''')} THEN 1 WHEN x.r RLIKE {_sql(r'^[\x20]?(%|€|[$]|km|kg|cm|pages|items)')} THEN -1 ELSE 0 END",
}
#: Features: name -> SQL over a candidate x with a small whole number.
FEATURES = {
    "kind": "array_position(array('" + "', '".join(ADDED) + "'), x.kind)",
    "length": "CASE WHEN length(x.m) < 12 THEN 0 WHEN length(x.m) < 18 THEN 1 WHEN length(x.m) < 32 THEN 2 WHEN length(x.m) < 48 THEN 3 ELSE 4 END",
    "digits": "CAST(floor(least(3, 4 * length(regexp_replace(x.m, '[^0-9]', '')) / length(x.m))) AS INT)",
    "hex": "CAST(x.m RLIKE '^[0-9a-f]+$' AS INT)",
    "upper": "CAST(x.m RLIKE '[A-Z]' AS INT)",
    "assigned": f"CAST(x.l RLIKE {_sql(r'[=:][\x20]*[\x22\x27]?$')} AS INT)",
    "worded": f"CAST(x.m RLIKE {_sql(r'[A-Za-z]{8,}')} AS INT)",
}


_SPANS = "ARRAY<STRUCT<kind: STRING, start: INT, stop: INT, m: STRING, l: STRING, r: STRING>>"


def _blocks(array: str, block: str) -> str:
    """SQL of about as many blocks (``block`` of their number k and length {step}) as each has items.

    A list that grows is copied at each step; with blocks, n items cost n times the root of n.
    """
    step = f"CAST(ceil(sqrt(size({array}))) AS INT)"
    return f"transform(sequence(0, CAST(ceil(size({array}) / {step}) AS INT) - 1), k -> {block.format(step=step)})"


def _placed(kind: str) -> str:
    """SQL of the matches of a kind with their places: lengths are summed within blocks, then over blocks.

    l and r are what stands before and behind: the last match and the text after it, and the text up to the next.
    """
    before, own = f"length(get(__s_{kind}, i))", f"length(get(__m_{kind}, i))"
    left = f"right(concat(coalesce(get(__m_{kind}, i - 1), ''), get(__s_{kind}, i)), {CONTEXT})"
    span = f"struct('{kind}' AS kind, a.p + {before} AS start, a.p + {before} + {own} AS stop, get(__m_{kind}, i) AS m, {left} AS l, left(get(__s_{kind}, i + 1), {CONTEXT}) AS r)"
    inner = f"aggregate(sequence(k * {{step}}, least(size(__m_{kind}), (k + 1) * {{step}}) - 1), struct(0 AS p, CAST(array() AS {_SPANS}) AS o), (a, i) -> struct(a.p + {before} + {own} AS p, array_append(a.o, {span}) AS o))"
    outer = f"aggregate({_blocks(f'__m_{kind}', inner)}, struct(0 AS p, CAST(array() AS ARRAY<STRUCT<at: INT, o: {_SPANS}>>) AS o), (a, x) -> struct(a.p + x.p AS p, array_append(a.o, struct(a.p AS at, x.o AS o)) AS o)).o"
    return f"flatten(transform({outer}, z -> transform(z.o, y -> struct(y.kind, y.start + z.at AS start, y.stop + z.at AS stop, y.m, y.l, y.r))))"


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with __base (spans of each base kind that hold) and __more (other candidates with votes and features)."""
    e = F.expr
    out = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = out.withColumn("__some", e("__text RLIKE '[0-9@]'")).withColumn("__titled", e(f"__text RLIKE {_sql(_TITLE)}"))
    when = {"email": "contains(__text, '@')", "handle": "contains(__text, '@')", "phone": "contains(__text, '+')", "name": "__titled"}
    patterns = {**BASE, **ADDED}
    parts = {}
    for kind, pattern in patterns.items():
        test = when.get(kind, "__some")
        if test != "__titled":
            test = f"__some AND {test}"
        parts[f"__m_{kind}"] = e(f"CASE WHEN {test} THEN regexp_extract_all(__text, {_sql(pattern)}, 0) END")
    out = out.withColumns(parts)
    # pieces are cut out only where something was found
    out = out.withColumns({f"__s_{kind}": e(f"CASE WHEN size(__m_{kind}) > 0 THEN split(__text, {_sql(pattern)}, -1) END") for kind, pattern in patterns.items()})
    spans = {f"__x_{kind}": e(f"CASE WHEN size(__m_{kind}) > 0 THEN filter({_placed(kind)}, x -> {_valid(kind, 'x.m')}) ELSE CAST(array() AS {_SPANS}) END") for kind in patterns}
    out = out.withColumns(spans)
    out = out.withColumn("__base", e("transform(concat(" + ", ".join(f"__x_{k}" for k in BASE) + "), x -> struct(x.kind, x.start, x.stop))"))
    out = out.withColumn("__more", e("concat(" + ", ".join(f"__x_{k}" for k in ADDED) + ")"))
    near = _blocks("__sorted", "transform(slice(__sorted, k * {step} + 1, {step}), y -> y)")
    out = out.withColumn("__sorted", e("array_sort(transform(__base, x -> struct(x.start, x.stop)))"))
    out = out.withColumn("__near", e(f"CASE WHEN size(__sorted) > 0 THEN transform({near}, z -> struct(get(z, 0).start AS lo, array_max(transform(z, y -> y.stop)) AS hi, z AS items)) END"))
    out = fence(out, ["__base", "__more", "__near"])
    meets = "b.start < x.stop AND x.start < b.stop AND NOT (x.kind = 'secret' AND x.start <= b.start AND b.stop <= x.stop AND x.stop - x.start > b.stop - b.start)"
    out = out.withColumn("__more", e(f"filter(__more, x -> __near IS NULL OR NOT exists(__near, z -> z.lo < x.stop AND x.start < z.hi AND exists(z.items, b -> {meets})))"))
    votes = ", ".join(f"CAST({v} AS INT)" for v in LABELERS.values())
    marks = ", ".join(f"concat('{k}=', CAST({v} AS STRING))" for k, v in FEATURES.items())
    out = out.withColumn("__more", e(f"transform(__more, x -> struct(x.kind, x.start, x.stop, array({votes}) AS votes, array({marks}) AS marks))"))
    return fence(out.select(*[F.col(f"`{c}`") for c in docs.columns], "__base", "__more"), ["__base", "__more"])


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 60) -> tuple[float, list[dict[int, tuple[float, float]]], dict[tuple[int, ...], float]]:
    """Prior, P(vote | not personal, personal) of each labeler, and the probability of each vote pattern, by EM.

    It begins at the majority of votes and adds one half to every count.
    """
    p = {v: 1 / (1 + math.exp(-1.5 * sum(v))) if any(v) else 0.4 for v in counts}
    total = sum(counts.values())
    prior, tables = 0.5, []
    for _ in range(rounds):
        prior = (sum(counts[v] * p[v] for v in counts) + 1) / (total + 2)
        tables = []
        for k in range(len(LABELERS)):
            own = {}
            for vote in (-1, 0, 1):
                yes = sum(c * p[v] for v, c in counts.items() if v[k] == vote)
                no = sum(c * (1 - p[v]) for v, c in counts.items() if v[k] == vote)
                own[vote] = ((no + 0.5) / (total * (1 - prior) + 1.5), (yes + 0.5) / (total * prior + 1.5))
            tables.append(own)
        for v in p:
            odds = math.log(prior / (1 - prior)) + sum(math.log(t[x][1] / t[x][0]) for t, x in zip(tables, v, strict=True))
            p[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return prior, tables, p


def train(rows: list[tuple[tuple[str, ...], float, int]], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> dict[str, float]:
    """Logistic weights of features from (features, probability, count); '' is the bias."""
    total = sum(c for _, _, c in rows) or 1
    weights = {"": 0.0} | {f: 0.0 for marks, _, _ in rows for f in marks}
    for _ in range(rounds):
        slope = {f: decay * w for f, w in weights.items()}
        for marks, p, c in rows:
            z = weights[""] + sum(weights[f] for f in marks)
            g = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * c / total
            slope[""] += g
            for f in marks:
                slope[f] += g
        for f in weights:
            weights[f] -= rate * slope[f]
    return weights


def fit(found: DataFrame) -> dict[str, float]:
    """The span classifier, from the output of ``candidates``."""
    rows = found.where(F.size("__more") > 0).select(F.explode("__more").alias("x")).groupBy("x.votes", "x.marks").count().collect()
    counts: dict[tuple[int, ...], int] = {}
    for votes, _, n in rows:
        counts[tuple(votes)] = counts.get(tuple(votes), 0) + n
    if not counts:
        return {"": -1.0}
    _, _, p = reliabilities(counts)
    grouped: dict[tuple[str, ...], list[float]] = {}
    for votes, marks, n in rows:
        own = grouped.setdefault(tuple(marks), [0.0, 0])
        own[0] += p[tuple(votes)] * n
        own[1] += n
    return train([(marks, s / n, n) for marks, (s, n) in sorted(grouped.items())])


def decide(found: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``found`` with spans: array of (kind, start, stop), by start, then kind as listed; drops the working columns."""
    table = F.create_map(*[x for k, w in weights.items() for x in (F.lit(k), F.lit(float(w)))])

    def passes(x: Column) -> Column:
        score = F.aggregate(x["marks"], F.lit(float(weights[""])), lambda a, f: a + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))
        return score >= 0

    rank = "array_position(array('" + "', '".join(KINDS) + "'), x.kind)"
    added = F.transform(F.filter("__more", passes), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
    out = found.withColumn("__all", F.concat("__base", added))
    out = out.withColumn("spans", F.expr(f"transform(array_sort(transform(__all, x -> struct(x.start, {rank} AS rank, x.stop, x.kind))), x -> struct(x.kind, x.start, x.stop))"))
    out = out.withColumn("base_spans", F.expr(f"transform(array_sort(transform(__base, x -> struct(x.start, {rank} AS rank, x.stop, x.kind))), x -> struct(x.kind, x.start, x.stop))"))
    return out.drop("__base", "__more", "__all")


def joined(spans: str) -> Column:
    """kind:start:end of the spans in the named column, comma-joined."""
    return F.array_join(F.transform(F.col(spans), lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def find_spans(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id, if not given) of every row with base_spans and spans; texts are read once."""
    found = materialize(candidates(docs.select(*(keep or ["doc_id"]), "text")).drop("text"), "spans")
    return decide(found, fit(found))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of a text replaced by its kind in angle brackets; n_chars follows."""
    weights = fit(materialize(candidates(docs.select("text")).drop("text"), "spans"))

    def work(own: DataFrame) -> DataFrame:
        out = decide(candidates(own), weights)
        # overlapping spans are one cut, named after the first; blocks of spans keep the pieces short that are cut from
        parts = _blocks("spans", "struct(slice(spans, k * {step} + 1, {step}) AS items, get(spans, k * {step}).start AS lo, coalesce(get(spans, (k + 1) * {step}).start, length(text)) AS hi)")
        parts = f"transform({parts}, z -> struct(z.items, z.lo, z.hi, substring(text, z.lo + 1, z.hi - z.lo) AS t))"
        inner = "aggregate(z.items, struct('' AS t, a.p AS p), (c, x) -> IF(x.start < c.p, struct(c.t AS t, greatest(c.p, x.stop) AS p), struct(concat(c.t, substring(z.t, c.p - z.lo + 1, x.start - c.p), '<', x.kind, '>') AS t, x.stop AS p)), c -> struct(concat(c.t, IF(c.p < z.hi, substring(z.t, c.p - z.lo + 1, z.hi - c.p), '')) AS t, greatest(c.p, z.hi) AS p))"
        whole = f"aggregate({parts}, struct(substring(text, 1, get(spans, 0).start) AS t, get(spans, 0).start AS p), (a, z) -> struct(concat(a.t, {inner}.t) AS t, {inner}.p AS p)).t"
        out = fence(out, ["spans"]).withColumn("text", F.expr(f"CASE WHEN size(spans) = 0 THEN text ELSE {whole} END"))
        return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in own.columns else out

    return shielded(docs, ("text", "n_chars"), work)
