"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers read the words of a clause as classes (insult, threat, modal, target, negation,
report, other): the insult transducer weighs an insult, the target transducer raises it where it is
aimed at someone, the threat transducer finds intent and deed aimed at someone, the negation
transducer lowers what follows a negation, and the reported-speech transducer lowers what is quoted
or told.  Their product is one deterministic machine whose arcs carry events; a clause is scored by
the events on its path.  A document's clause scores are the features of a logistic model.

Insults are learned: words, and stems (the first ``STEMS`` letters of longer words, written with *),
of toxic sample documents that occur there in at least ``CONTEXTS`` different surroundings (so that
copies of one text don't teach its rare words), with the log-odds of toxic documents as weights.  The
sample has at most about ``SAMPLE`` labelled rows, chosen by a hash of the id, and bounds the lexicon.

Defined results: null and empty texts have no clause and the score of a text without a match; of words that
begin at one place the automaton's first counts; equal rows give equal rows; an empty table gives no rows; without labels every score is 0; other columns
than the named ones are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.llm.shingles import texts
from gneiss.llm.storage import materialize

SAMPLE, CONTEXTS, LEAST_ODDS = 20_000, 8, 2.0
STEMS = (4, 5, 6)

THREATS = set("kill murder hurt beat stab shoot burn destroy attack punch strangle hang bomb rape crush töten schlagen umbringen verletzen tuer tuerai frapper blesser matar golpear herir destruir".split())
MODALS = set("will gonna going shall should must want wanna werde werden soll vais va veux voy vamos quiero".split())
TARGETS = set("you your yours yourself u he him his she her they them their these those this that all everyone du dich dein ihr euch sie er tu te toi ton vous ils elle il usted ustedes tú él ella ellos vosotros".split())
NEGATIONS = set("not no never neither nor isn't aren't wasn't don't doesn't didn't cannot can't nicht kein keine nie pas jamais aucun nunca jamás ningún sin".split())
REPORTS = set("said says say saying told tells wrote writes claimed claims reported quoted called calls according allegedly sagte sagt schrieb dit disait dijo dice escribió".split())
CLASSES = ("other", "insult", "threat", "modal", "target", "negation", "report")
_OTHER, _INSULT, _THREAT, _MODAL, _TARGET, _NEGATION, _REPORT = range(7)
_CLAUSE = re.compile(r"[.!?;\n\r]+")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”«»]")


def forms(word: str) -> list[str]:
    """The word and its stems."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


class Transducer:
    """States from 0; step(state, class) gives the next state and the event on the arc (or None)."""

    def __init__(self, step):
        self.step = step


def _target(state, c):
    # 0: nobody yet; 1..4: someone named that many words ago, at most
    return (4 if c == _TARGET else max(0, state - 1)), ("aimed" if c == _INSULT and state else None)


def _after(state, c):
    # 1..3: an insult that many words ago meets its target late
    if c == _INSULT:
        return 3, None
    return max(0, state - 1) if c != _TARGET else 0, ("late" if c == _TARGET and state else None)


def _threat(state, c):
    # 0 nothing, 1 intent, 2..4 intent and deed, waiting for whom
    if c == _MODAL:
        return 1, None
    if c == _THREAT:
        return (4 if state else 2), ("deed" if state else None)
    if c == _TARGET and state >= 2:
        return 0, "threat"
    return (state if state == 1 else max(0, state - 1) if state > 2 else 0), None


def _negation(state, c):
    if c == _NEGATION:
        return 4, None
    return max(0, state - 1), ("negated" if state and c in (_INSULT, _THREAT) else None)


def _report(state, c):
    if c == _REPORT:
        return 1, None
    return state, ("reported" if state and c in (_INSULT, _THREAT) else None)


def _insult(state, c):
    return 0, ("insult" if c == _INSULT else None)


def compose(*parts: Transducer) -> tuple[list[list[int]], list[list[tuple[str, ...]]]]:
    """The product machine: next state and events by state and class."""
    start = tuple(0 for _ in parts)
    number, queue = {start: 0}, [start]
    arcs: list[list[int]] = []
    events: list[list[tuple[str, ...]]] = []
    for state in queue:
        row, out = [], []
        for c in range(len(CLASSES)):
            moved = [p.step(s, c) for p, s in zip(parts, state, strict=True)]
            after = tuple(m[0] for m in moved)
            if after not in number:
                number[after] = len(queue)
                queue.append(after)
            row.append(number[after])
            out.append(tuple(m[1] for m in moved if m[1]))
        arcs.append(row)
        events.append(out)
    return arcs, events


@lru_cache(maxsize=1)
def grammar():
    """The composed machine."""
    return compose(*map(Transducer, (_insult, _target, _after, _threat, _negation, _report)))


FEATURES = ("score", "clauses", "aimed", "threats", "softened", "density", "any", "several")


class Matcher:
    """Scores the clauses of texts; only clauses with an insult or a threat word are read word by word."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick

        self.lexicon = lexicon
        self.classes = {w: k for k, words in ((_TARGET, TARGETS), (_MODAL, MODALS), (_THREAT, THREATS), (_NEGATION, NEGATIONS), (_REPORT, REPORTS)) for w in words}
        self.classes |= {w: _INSULT for w in lexicon} | {c: _REPORT for c in "\"“”«»"}
        self.find = ahocorasick.Automaton()
        for w in {*lexicon, *THREATS}:
            self.find.add_word(w.rstrip("*"), (len(w.rstrip("*")), w.rstrip("*") + "*" in lexicon))
        self.find.make_automaton()
        self.arcs, self.events = grammar()

    def features(self, text: str) -> list[float]:
        """FEATURES of a text."""
        low = text.lower()
        spans: list[tuple[int, int]] = []
        edges = None
        for end, (n, stem) in self.find.iter(low):
            a, b = end + 1 - n, end + 1
            if (a and low[a - 1].isalpha()) or (not stem and b < len(low) and low[b].isalpha()):
                continue
            if spans and a < spans[-1][1]:
                continue
            if edges is None:  # ends and starts of what parts clauses, with the text's own
                parted = [m.span() for m in _CLAUSE.finditer(low)]
                edges = [0, *(e for _, e in parted)], [*(s for s, _ in parted), len(low)]
            spans.append((edges[0][bisect_right(edges[0], a) - 1], edges[1][bisect_left(edges[1], b)]))
        out = [0.0] * len(FEATURES)
        for a, b in spans:
            score, aimed, threat, soft, hits = self._read(low[a:b])
            out[0] += score
            out[1] += score > 0
            out[2] += aimed
            out[3] += threat
            out[4] += soft
            out[7] += hits
        out[5] = out[0] / (len(text) / 500 + 1)
        out[6] = float(out[0] > 0)
        out[7] = float(out[7] >= 2)
        return [np.log1p(x) if k in (0, 1, 2, 4, 5) else x for k, x in enumerate(out)]

    def _read(self, clause: str) -> tuple[float, int, int, int, int]:
        state, score, weight, aimed, threat, soft, hits = 0, 0.0, 0.0, 0, 0, 0, 0
        for word in _WORD.findall(clause):
            word = word.replace("’", "'")
            c = self.classes.get(word, _OTHER)
            if c in (_OTHER, _INSULT):
                known = [self.lexicon[f] for f in forms(word) if f in self.lexicon]
                c = _INSULT if known else _OTHER
            for event in self.events[state][c]:
                if event == "insult":
                    weight = max(known)
                    score += weight
                    hits += 1
                elif event in ("aimed", "late"):
                    score += 0.5 * weight
                    aimed += 1
                elif event in ("deed", "threat"):
                    score += 1.5
                    threat += event == "threat"
                elif event == "negated":
                    score -= 0.6 * weight
                    soft += 1
                elif event == "reported":
                    score -= 0.3 * weight
                    soft += 1
            state = self.arcs[state][c]
        return max(0.0, score), aimed, threat, soft, hits


@dataclass
class Model:
    """Insults with weights, and the logistic model over FEATURES (bias first)."""

    lexicon: dict[str, float]
    weights: list[float]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out():
    """Whether a row is kept from learning: crc32 of the id as text leaves 0 by 5 (null ids: false)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def sample_labelled(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """text and toxic of about ``rows`` labelled rows that aren't held out, at most."""
    known = labels.where(~held_out()).where("toxic IS NOT NULL").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).distinct()
    return materialize(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "labelled")


def learn(sample: DataFrame) -> Model:
    """The lexicon and the weights from ``sample`` (text, toxic)."""

    def surroundings(batches):
        for batch in texts(batches, at=0):
            words, around = [], []
            for text in batch.column(0).to_pylist():
                own = ["", *_WORD.findall((text or "").lower()), ""]
                seen = {(f, own[k] + " " + own[k + 2]) for k, w in enumerate(own[1:-1]) if len(w) > 2 for f in forms(w)}
                words += [w for w, _ in seen]
                around += [a for _, a in seen]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(around, pa.string())], ["word", "around"])

    toxic = sample.where("toxic = 1").select("text").mapInArrow(surroundings, "word string, around string")
    found = toxic.groupBy("word").agg(F.count_distinct("around").alias("n")).where(F.col("n") >= CONTEXTS)
    candidates = {r[0] for r in found.collect()}

    def presence(batches):
        total = {}
        for batch in texts(batches, at=0):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in candidates.intersection(f for w in set(_WORD.findall((text or "").lower())) for f in forms(w)) | {""}:
                    total[w, label] = total.get((w, label), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in total], pa.string()), pa.array([x for _, x in total], pa.int32()), pa.array(list(total.values()), pa.int64())], ["word", "toxic", "n"])

    counts: dict[str, list[int]] = {}
    for w, label, n in sample.select("text", "toxic").mapInArrow(presence, "word string, toxic int, n bigint").groupBy("word", "toxic").agg(F.sum("n")).collect():
        counts.setdefault(w, [0, 0])[int(label == 1)] += n
    no, yes = counts.pop("", [0, 0])
    if not yes:
        return Model({}, [-30.0] + [0.0] * len(FEATURES))
    odds = {w: np.log((b + 0.5) / (yes + 1)) - np.log((a + 0.5) / (no + 1)) for w, (a, b) in counts.items() if b >= CONTEXTS}
    lexicon = {w: float(min(x, 6)) for w, x in sorted(odds.items()) if x >= LEAST_ODDS}

    def measured(batches):
        matcher = Matcher(lexicon)
        for batch in texts(batches, at=0):
            own = [matcher.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(measured, "x array<double>, toxic int").groupBy("x", "toxic").count().toArrow()
    x = np.array(rows.column(0).to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y, n = (rows.column(1).to_numpy() == 1).astype(float), rows.column(2).to_numpy().astype(float)
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton's steps with a ridge
        p = _sigmoid(x @ w)
        hessian = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag([1e-6] + [0.5] * len(FEATURES))
        gradient = x.T @ (n * (y - p)) - np.array([0] + [0.5] * len(FEATURES)) * w
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return Model(lexicon, w.tolist())


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every text."""
    docs = docs.select("doc_id", "text")

    def run(batches):
        matcher, w = Matcher(model.lexicon), np.array(model.weights)
        for batch in texts(batches):
            x = np.array([matcher.features(t or "") for t in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            p = _sigmoid(x @ w[1:] + w[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted: learned from labelled rows that aren't held out."""
    model = learn(sample_labelled(docs, labels))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
