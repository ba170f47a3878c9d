"""Language identification by multilingual mixture inference.

A language is a distribution over letter trigrams (64 symbols: space for all that is no letter, a-z, and
the bytes of other letters in 37 cells), learned from all labelled texts.  A document is a mixture: expectation-
maximisation over its trigrams estimates the proportion of every language, and the number of
languages is chosen by likelihood less ``PENALTY`` * log(trigrams) for each language beyond the first,
adding the next largest proportion as long as that pays.

Defined results: null texts and texts without a letter (of any script) are und with score 0, and so is any
text where nothing was learned; a text that has letters, but no two of them in three characters, is judged by
single letters; ties go to the language that sorts first; equal rows give equal rows; an empty
table gives no rows; other columns than the named ones are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.shingles import slices, text_buffer

#: More languages than this are an error: the driver holds a row of CELLS numbers for each.
LANGUAGES = 500
SYMBOLS = 64
CELLS = SYMBOLS**3
PENALTY, ROUNDS, SMOOTH = 4.0, 8, 0.2
#: Trigrams overlap: each counts as a third of an observation.
WEIGHT = 1 / 3

_SYMBOL = np.zeros(256, dtype=np.uint8)
for _b in range(256):
    if 97 <= _b <= 122 or 65 <= _b <= 90:
        _SYMBOL[_b] = (_b | 32) - 96
    elif _b >= 128:
        _SYMBOL[_b] = 27 + _b % 37


#: Characters beyond ASCII that are no letters.
_OTHER = re.compile(r"(?![\x00-\x7f])[\W\d_]")


def _lowered(text: str | None) -> str:
    text = (text or "").lower()
    return text if text.isascii() else _OTHER.sub(" ", text)


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of every trigram with two letters at least, or one in rows with none such; a space stands around every row."""
    data, offsets = text_buffer(pa.array([_lowered(t) for t in column.to_pylist()], pa.string()))
    rows = len(offsets) - 1
    size = np.diff(offsets) + 2
    ends = np.cumsum(size)
    symbols = np.zeros(int(ends[-1]) if rows else 0, dtype=np.uint8)
    inner = np.ones(len(symbols), bool)
    inner[ends - 1] = False
    inner[ends - size] = False
    symbols[inner] = _SYMBOL[data]
    if len(symbols) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = (symbols > 0).astype(np.int8)
    letters = letters[2:] + letters[1:-1] + letters[:-2]
    inside = np.ones(len(symbols), bool)  # a trigram ends before its row does
    inside[ends - 1] = inside[ends - 2] = False
    at = np.flatnonzero(inside[:-2] & (letters >= 2))
    row = np.searchsorted(ends, at, side="right")
    poor = np.ones(rows, bool)
    poor[row] = False
    if poor.any():
        more = np.flatnonzero(inside[:-2] & (letters == 1))
        own = np.searchsorted(ends, more, side="right")
        at, row = np.concatenate([at, more[poor[own]]]), np.concatenate([row, own[poor[own]]])
        order = np.argsort(row, kind="stable")
        at, row = at[order], row[order]
    own = symbols.astype(np.int32)
    return row, ((own[at] * SYMBOLS + own[at + 1]) * SYMBOLS + own[at + 2]).astype(np.int64)


@dataclass
class Model:
    """Languages and the probability of each cell in each (cells x languages)."""

    languages: list[str]
    table: np.ndarray


def learn(labelled: DataFrame, smooth: float = SMOOTH) -> Model:
    """The model from all rows of ``labelled`` (text, lang); rows without a language teach nothing.

    Counts are summed on the executors; the driver gets one number for each cell and language.
    """
    labelled = labelled.where("lang IS NOT NULL").select(F.col("text").cast("string").alias("text"), "lang")

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            whole = np.array(batch.column(1).to_pylist(), dtype=object)
            for start, part in slices(batch.column(0)):
                lang = whole[start : start + len(part)]
                row, cell = trigrams(part)
                for name in sorted(set(lang)):
                    held, n = np.unique(cell[(lang == name)[row]], return_counts=True)
                    if name not in total:
                        total[name] = np.zeros(CELLS, np.int64)
                    total[name][held] += n
        for name, n in total.items():
            held = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(held), pa.string()), pa.array(held), pa.array(n[held])], ["lang", "cell", "n"])

    rows = labelled.mapInArrow(run, "lang string, cell bigint, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow()
    lang, cell, n = (rows.column(k).to_pylist() for k in range(3))
    languages = sorted(set(lang))
    if len(languages) > LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the model is made for {LANGUAGES} at most")
    table = np.full((CELLS, len(languages)), smooth)
    at = {name: k for k, name in enumerate(languages)}
    if languages:
        np.add.at(table, (np.array(cell), np.array([at[x] for x in lang])), np.array(n, dtype=float))
        table /= table.sum(axis=0)
    return Model(languages, table)


def _mixture(probability, count, starts, rows, share, rounds):
    """Proportions (rows x languages) by expectation-maximisation, and the log-likelihood of each row."""
    index = np.repeat(np.arange(rows), np.diff(starts))
    total = np.add.reduceat(count, starts[:-1])
    for _ in range(rounds):
        part = probability * share[index]
        part *= (count / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, starts[:-1], axis=0) / total[:, None]
    likelihood = np.add.reduceat(count * np.log((probability * share[index]).sum(axis=1)), starts[:-1])
    return share, likelihood


def infer(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and proportions of each text."""
    rows, languages = len(column), len(model.languages)
    names, score, shares = ["und"] * rows, np.zeros(rows), np.zeros((rows, languages))
    row, cell = trigrams(column)
    if not languages or not len(row):
        return names, score, shares
    key, count = np.unique(row * CELLS + cell, return_counts=True)
    count = count * WEIGHT
    row, probability = key // CELLS, model.table[key % CELLS]
    held, starts = np.unique(row, return_index=True)
    starts = np.append(starts, len(row))
    size = np.add.reduceat(count, starts[:-1])
    single = np.add.reduceat(count[:, None] * np.log(probability), starts[:-1], axis=0)
    full, _ = _mixture(probability, count, starts, len(held), np.full((len(held), languages), 1 / languages), ROUNDS)
    best = single.argmax(axis=1)
    value = single.max(axis=1)
    chosen = np.zeros_like(full)
    chosen[np.arange(len(held)), best] = 1
    certain = np.exp(single - value[:, None])
    certain = 1 / certain.sum(axis=1)  # of the best language, if there is but one
    order = np.argsort(-full, axis=1, kind="stable")
    live = np.arange(len(held))
    for k in range(2, languages + 1):
        if not len(live):
            break
        mask = np.zeros((len(live), languages))
        np.put_along_axis(mask, order[live, :k], 1, axis=1)
        pick = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in live])
        own = np.concatenate([[0], np.cumsum(np.diff(starts)[live])])
        begin = np.maximum(full[live], 1e-3) * mask
        share, likelihood = _mixture(probability[pick], count[pick], own, len(live), begin / begin.sum(axis=1, keepdims=True), ROUNDS // 2)
        worth = likelihood - PENALTY * (k - 1) * np.log(size[live] + 1)
        better = worth > value[live]
        chosen[live[better]], value[live[better]], certain[live[better]] = share[better], worth[better], 1
        live = live[better]
    top = chosen.argmax(axis=1)
    for i, r in enumerate(held):
        names[r] = model.languages[top[i]]
    score[held] = np.clip(chosen[np.arange(len(held)), top] * certain, 0, 1)
    shares[held] = chosen
    return names, score, shares


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and shares (language -> proportion of the chosen set); columns of these names go."""
    docs = docs.drop("lang_pred", "score", "shares")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # working names that no column of the table has
    out = docs.withColumn("__text", F.col("text").cast("string"))
    at = out.columns.index("__text")

    def run(batches):
        model = sent.value
        for batch in batches:
            parts = [infer(part, model) for _, part in slices(batch.column(at))]
            names = [n for p in parts for n in p[0]]
            score, shares = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in (1, 2))
            mixed = [{n: float(x) for n, x in zip(model.languages, s, strict=True) if x > 0} for s in shares]
            columns = [c for k, c in enumerate(batch.columns) if k != at]
            kept = [c for k, c in enumerate(batch.schema.names) if k != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array([list(m.items()) for m in mixed], pa.map_(pa.string(), pa.float64()))], [*kept, "lang_pred", "score", "shares"])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), "lang_pred string, score double, shares map<string,double>"])
    return out.mapInArrow(run, fields)


def held_out(docs: DataFrame):
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 by 4 (null ids: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that aren't held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(docs)))
    return identify(docs.select("doc_id", held_out(docs).alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
