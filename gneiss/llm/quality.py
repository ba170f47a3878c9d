"""Line-first quality rules, in built-in DataFrame functions only.

Words are runs of characters other than space and tab..carriage return.  Each line with a word is
judged alone; lines that fail a rule go; a document goes if its lines that stay hold less than
``KEEP`` percent of its word characters, or if it fails the base rules.

Line rules: too many symbols for its words (markup, menus of | items); runs of ! or ?; capitals
throughout; a short line that ends without punctuation (navigation); a short line of site
boilerplate; a long line without any punctuation.

Defined results: null texts have no words and fail; an empty table gives no rows; equal rows give
equal rows; ``judge`` replaces columns that have the names of its results, ``clean`` keeps all columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.storage import fence, shielded

KEEP = 60
MIN_WORDS = 50
MAX_REPEATED = 50

_ADDED = ("clean_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
_WS = r"[\\x20\\x09-\\x0D]"
_SYMBOLS = "#*$%&|<>"
#: Phrases of site boilerplate.
_SITE = "(?i)(accept (all )?cookies|uses cookies|cookie policy|privacy policy|terms of (use|service)|all rights reserved|enable javascript|click here|read more|sign up|log in|subscribe (now|to)|share (this|on)|skip to content|lorem ipsum)"


def _without(x: str, some: str) -> str:
    """SQL of how many characters of ``x`` are among ``some``."""
    return f"(length({x}) - length(translate({x}, '{some}', '')))"


def _measured(lines: str) -> str:
    """SQL of the lines (l) with their words (n), symbols and capitals, each counted once."""
    words = "regexp_count(x, '[^\\\\x20\\\\x09-\\\\x0D]+')"
    return f"transform({lines}, x -> struct(x AS l, {words} AS n, {_without('x', _SYMBOLS)} AS symbols, {_without('x', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')} AS capitals))"


#: SQL condition on a measured line ``x`` that has a word.
_FAILS = f"""(
    4 * x.symbols >= x.n
    OR ((contains(x.l, '!') OR contains(x.l, '??')) AND 4 * regexp_count(x.l, '[!?]{{2,}}') >= x.n)
    OR (x.capitals >= 10 AND x.capitals > 5 * regexp_count(x.l, '[a-z]'))
    OR (x.n <= 3 AND NOT x.l RLIKE '[.!?:;,)\\\\]"][\\\\x20\\\\x09-\\\\x0D]*$')
    OR (x.n <= 20 AND x.l RLIKE '{_SITE}')
    OR (x.n >= 60 AND NOT x.l RLIKE '[.,;:!?]')
)"""


def judge(docs: DataFrame, keep: int = KEEP) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, clean_text, kept."""
    e = F.expr
    out = docs.withColumn("__text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    out = out.withColumn("__words", e(f"array_remove(split(__text, '{_WS}+'), '')"))
    out = out.withColumn("__lines", e("filter(split(__text, '\\n'), x -> x RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"))
    out = out.withColumn("__n", F.size("__words"))
    # hashes of all three-word windows differ in most texts: then none repeats, and nothing is sorted
    out = out.withColumn("__hashes", e("CASE WHEN __n > 3 THEN transform(slice(__words, 1, __n - 2), (x, i) -> xxhash64(x, get(__words, i + 1), get(__words, i + 2))) END"))
    out = out.withColumn("__sorted", e("CASE WHEN size(array_distinct(__hashes)) < __n - 2 THEN sort_array(transform(slice(__words, 1, __n - 2), (x, i) -> struct(concat_ws(' ', x, get(__words, i + 1), get(__words, i + 2)) AS t, i AS p))) END"))
    out = out.withColumn("__twice", e("filter(__sorted, (x, i) -> coalesce(x.t = get(__sorted, i - 1).t, false) OR coalesce(x.t = get(__sorted, i + 1).t, false))"))
    out = out.withColumn("__stay", e(f"transform(filter({_measured('__lines')}, x -> NOT {_FAILS}), x -> x.l)"))
    out = out.withColumn("clean_text", F.array_join("__stay", "\n"))
    out = out.withColumns(
        {
            "n_words": F.col("__n").cast("bigint"),
            "word_chars": F.length(F.array_join("__words", "")).cast("bigint"),
            "n_symbols": e(_without("__text", _SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": e("coalesce(size(array_distinct(flatten(transform(__twice, x -> sequence(x.p, x.p + 2))))), 0)").cast("bigint"),
            "__stay_chars": F.length(F.regexp_replace("clean_text", r"[\x20\x09-\x0D]+", "")).cast("bigint"),
        }
    )
    out = out.withColumn("base_failed", e(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"))
    out = out.withColumn("kept", e(f"NOT base_failed AND 100 * __stay_chars >= {keep} * word_chars"))
    out = out.drop(*[c for c in out.columns if c.startswith("__") and c not in docs.columns])
    return fence(out, [c for c in out.columns if c not in docs.columns or c in _ADDED])


def clean(docs: DataFrame, keep: int = KEEP) -> DataFrame:
    """The documents that stay, with the lines that stay; the columns are those of ``docs``."""

    def work(own: DataFrame) -> DataFrame:
        changed = {"text": F.col("clean_text")} | ({"n_chars": F.length("clean_text").cast("bigint")} if "n_chars" in own.columns else {})
        return judge(own, keep).where("kept").withColumns(changed)

    return shielded(docs, ("text", "n_chars"), work)


_DUCK_FAILS = r"""(
    4 * len(regexp_extract_all(l, '[#*$%&|<>]')) >= n
    OR 4 * len(regexp_extract_all(l, '[!?]{2,}')) >= n
    OR (len(regexp_extract_all(l, '[A-Z]')) >= 10 AND len(regexp_extract_all(l, '[A-Z]')) > 5 * len(regexp_extract_all(l, '[a-z]')))
    OR (n <= 3 AND NOT regexp_matches(l, '[.!?:;,)\]"][\x20\x09-\x0D]*$'))
    OR (n <= 20 AND regexp_matches(l, '""" + _SITE + r"""'))
    OR (n >= 60 AND NOT regexp_matches(l, '[.,;:!?]'))
)"""

ORACLE = (
    r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d
), windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1
), repeated AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r
), lines AS (
  SELECT r, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
), judged AS (
  SELECT r, count(*) - count(DISTINCT l) AS dup,
         coalesce(sum(CASE WHEN NOT """
    + _DUCK_FAILS
    + r""" THEN length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')) END), 0) AS stay
  FROM lines WHERE n > 0 GROUP BY r
), base AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(stay, 0) AS stay
  FROM w LEFT JOIN repeated USING (r) LEFT JOIN judged USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < """
    + str(MIN_WORDS)
    + " OR 100 * n_repeat_words > "
    + str(MAX_REPEATED)
    + r""" * n_words) AS base_failed,
       NOT (n_words < """
    + str(MIN_WORDS)
    + " OR 100 * n_repeat_words > "
    + str(MAX_REPEATED)
    + " * n_words) AND 100 * stay >= "
    + str(KEEP)
    + r""" * word_chars AS kept
FROM base
"""
)
