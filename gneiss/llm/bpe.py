"""Byte-level BPE by padded matrices.

The pre-tokens of a batch that no earlier batch had are put into matrices by byte length.  In every
round each row merges its leftmost pair of least rank; ranks come from a hash table over id pairs,
and rows without a pair that merges leave the matrix.  Pre-tokens beyond ``LONGEST`` bytes, whose
rounds would cost the square of their length, keep their pairs in a heap; the merges are the same.

Defined results: null texts are empty texts; an empty text has no ids; an empty table gives no rows;
columns other than the two named are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from gneiss.llm.shingles import texts


LONGEST = 512
KEPT_WORDS = 400_000
_NEVER = np.int32(2**31 - 1)


def default_ranks() -> str:
    """The path of the ranks that queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Vocabulary(dict):
    """Numbers words in the order of their first look-up; ``new`` holds those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self[word] = at = len(self)
        return at


class PairTable:
    """Rank of the token that two neighbouring tokens make, in an open hash table of numpy arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.bits = max(4, (len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, 2**64 - 1, dtype=np.uint64)
        self.values = np.full(1 << self.bits, _NEVER, dtype=np.int32)
        keys, values = np.array(list(pairs), dtype=np.uint64), np.array(list(pairs.values()), dtype=np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == np.uint64(2**64 - 1)
            first = np.zeros(len(keys), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            keys, values, at = keys[~put], values[~put], (at[~put] + 1) & (len(self.keys) - 1)
        self.one = pairs

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks for arrays of ids; a pair that makes no token, or with a negative id, never merges."""
        keys = left.astype(np.uint64) << np.uint64(32) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], _NEVER)
        open_ = np.flatnonzero((found != keys) & (found != np.uint64(2**64 - 1)))
        at = at[open_]
        while len(open_):
            at = (at + 1) & (len(self.keys) - 1)
            found = self.keys[at]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            more = ~hit & (found != np.uint64(2**64 - 1))
            open_, at = open_[more], at[more]
        return out


class Codec:
    """Encoder and decoder for one file of ranks."""

    def __init__(self, path: str, pattern: str | None = None):
        import public_tokenizers

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = regex.compile(pattern or public_tokenizers.PATTERN).findall
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.pairs = PairTable(self.ranks)
        self.forget()

    def forget(self) -> None:
        self.known = Vocabulary()
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each pre-token."""
        out: list[np.ndarray] = [self.byte[:0]] * len(words)
        buckets: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            n = len(w)
            if n > LONGEST:
                out[i] = self._heap(w)
            elif n in (0, 1):
                out[i] = self.byte[list(w)]
            else:
                buckets.setdefault(n if n <= 16 else -(-n // 16) * 16, []).append(i)
        for width, rows in buckets.items():
            step = max(1, 4_000_000 // width)
            for k in range(0, len(rows), step):
                self._matrix(words, rows[k : k + step], width, out)
        return out

    def _matrix(self, words: list[bytes], rows: list[int], width: int, out: list[np.ndarray]) -> None:
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in rows), dtype=np.uint8).reshape(len(rows), width)
        size = np.array([len(words[i]) for i in rows])
        ids = self.byte[raw]
        ids[np.arange(width) >= size[:, None]] = -1
        row = np.array(rows)
        rank = self.pairs(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        rank[ids[:, 1:] < 0] = _NEVER
        while len(row):
            at = rank.argmin(axis=1)
            line = np.arange(len(row))
            least = rank[line, at]
            done = least == _NEVER
            if done.any():
                for r in np.flatnonzero(done):
                    out[row[r]] = ids[r, : size[r]].copy()
                ids, rank, row, size, at, least = (x[~done] for x in (ids, rank, row, size, at, least))
                if not len(row):
                    break
                widest = int(size.max())
                ids, rank = np.ascontiguousarray(ids[:, :widest]), np.ascontiguousarray(rank[:, : widest - 1])
                line = np.arange(len(row))
            wide = ids.shape[1]
            column = np.arange(wide)
            # everything behind the merged pair moves one to the left
            source = np.minimum(column + (column > at[:, None]), wide - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = np.where(size == wide, -1, ids[:, -1])
            ids[line, at] = least
            size = size - 1
            if wide > 1:
                rank = np.take_along_axis(rank, np.minimum(source[:, :-1], wide - 2), axis=1)
                rank[:, -1] = _NEVER
                for side in (-1, 0):
                    k = at + side
                    ok = np.flatnonzero((k >= 0) & (k + 1 < size))
                    rank[ok, k[ok]] = self.pairs(ids[ok, k[ok]], ids[ok, k[ok] + 1])
                    gone = np.flatnonzero((k >= 0) & (k + 1 >= size) & (k < wide - 1))
                    rank[gone, k[gone]] = _NEVER

    def _heap(self, word: bytes) -> np.ndarray:
        ids = self.byte[np.frombuffer(word, np.uint8)].tolist()
        n, get = len(ids), self.pairs.one.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if i < n else n
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[y]))
        return np.array([x for x in ids if x >= 0], dtype=np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.known) > KEPT_WORDS:
            self.forget()
        words = [self.split(t) for t in texts]
        index = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), np.int64)
        if self.known.new:
            fresh = self.encode_words([w.encode() for w in self.known.new])
            self.known.new.clear()
            sizes = np.array([len(x) for x in fresh], dtype=np.int64)
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.flat = np.concatenate([self.flat, *fresh])
        sizes = self.sizes[index]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[index] - (ends - sizes), sizes) + np.arange(total)]
        ends = np.concatenate([[0], ends])[np.cumsum([0, *map(len, words)])]
        return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


@lru_cache(maxsize=2)
def load_codec(path: str) -> Codec:
    """One codec a Python worker and file."""
    return Codec(path)


def encode_texts(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id and the ids of every text."""
    path = ranks or default_ranks()
    docs = docs.select("doc_id", "text")

    def run(batches):
        codec = load_codec(path)
        for batch in texts(batches):
            ids = codec.encode([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """doc_id and the bytes that the ids of every row stand for (null ids: no bytes)."""
    path = ranks or default_ranks()
    encoded = encoded.select("doc_id", "ids")

    def run(batches):
        codec = load_codec(path)
        for batch in batches:
            data = [b"".join(codec.bytes_of[i] for i in x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """encode_texts and decode_ids in one pass, as digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    path = ranks or default_ranks()
    docs = docs.select("doc_id", "text")

    def run(batches):
        codec = load_codec(path)
        for batch in texts(batches):
            n, ids_sha, decoded_sha = [], [], []
            for ids in codec.encode([t or "" for t in batch.column(1).to_pylist()]):
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(np.ascontiguousarray(ids, dtype="<u4")).hexdigest())
                decoded_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
