"""Best-two-fit packing of tokenised documents into fixed-length sequences.

A document becomes its token ids and one end id; one that is longer than a sequence is cut into whole
sequences, whose first piece takes the remainder.  Pieces are dealt by a hash into groups of about
``group_rows``; each group is packed alone, so that the number of tasks follows the input and a task's
memory does not.  In a group only the lengths matter: best-two-fit runs over the histogram of lengths
and applies one bin's pattern as often as the counts allow, which gives the bins that packing one at
a time gives.

Defined results: null and empty texts are one piece with the end id alone; rows with equal ids are
packed on their own; an empty table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from gneiss.llm.shingles import texts
from gneiss.llm.storage import materialize

_RARE = re.compile("[^\x00-ɏ]")


def default_tokenizer() -> str:
    """The path of the vocabulary that queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def load_encoder(path: str):
    """text -> uint32 ids of the byte-level BPE in the tokenizers file at ``path``.

    Texts of Latin letters go through a rank encoder that is built from the same file and gives the
    same ids in a third of the time; texts with any later code point go through the tokenizers library.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    @lru_cache(maxsize=1)
    def slow():
        own = Tokenizer.from_file(path)
        own.encode_special_tokens = True
        return own

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"] for x in spec.get("added_tokens", ()) if x.get("special")}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of_char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    ranks = {bytes(of_char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if text.isascii() or not _RARE.search(text):
            return fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        return np.array(slow().encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all of ``size``, but the first may be shorter."""
    first = n % size or min(n, size)
    return [(0, first), *((s, size) for s in range(first, n, size))]


def tokenize_pieces(docs: DataFrame, tokenizer: str | None = None, size: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids."""
    path = tokenizer or default_tokenizer()
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches):
        encode = load_encoder(path)
        end = np.array([end_id], dtype=np.uint32)
        for batch in texts(batches):
            took, piece, start, length, crc, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                own = np.concatenate([encode(text.as_py() or ""), end])
                for k, (s, n) in enumerate(cut(len(own), size)):
                    part = np.ascontiguousarray(own[s : s + n], dtype="<u4")
                    took.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part.astype(np.int32))
            columns = [batch.column(0).take(pa.array(took, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    return docs.mapInArrow(run, schema)


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Bins for ``counts`` items of each length: (lengths in a bin, bins of that kind), in order.

    A bin takes the longest item left that fits, again and again; then its smallest item gives way
    to the two items left whose sum fits the gap that this opens best, if they fill it better.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    sizes = sorted(left)
    bins: list[tuple[list[int], int]] = []
    while sizes:
        used: dict[int, int] = {}
        rest = lambda n: left[n] - used.get(n, 0)
        own, gap = [], size
        at = len(sizes) - 1
        while gap and (at := min(at, bisect_right(sizes, gap) - 1)) >= 0:
            if rest(sizes[at]):
                own.append(sizes[at])
                used[sizes[at]] = used.get(sizes[at], 0) + 1
                gap -= sizes[at]
            else:
                at -= 1
        if gap and own:
            small = own[-1]
            room, best, pair = gap + small, small, None
            i, j = 0, bisect_right(sizes, room) - 1
            while i <= j and best < room:
                a, b = sizes[i], sizes[j]
                if not rest(a):
                    i += 1
                elif not rest(b):
                    j -= 1
                elif a + b > room:
                    j -= 1
                else:
                    if a + b > best and (i < j or rest(a) > 1):
                        best, pair = a + b, (b, a)
                    i += 1
            if pair:
                own.pop()
                used[small] -= 1
                for n in pair:
                    own.append(n)
                    used[n] = used.get(n, 0) + 1
        times = min(left[n] // u for n, u in used.items() if u)
        bins.append((own, times))
        for n, u in used.items():
            left[n] -= u * times
        sizes = [n for n in sizes if left[n]]
    return bins


def assign(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of every item; bins are numbered from 0."""
    values, counts = np.unique(lengths, return_counts=True)
    slot_length, slot_bin, slot_offset = [], [], []
    first = 0
    for own, times in best_two_fit(dict(zip(values.tolist(), counts.tolist(), strict=True)), size):
        offset = 0
        for n in own:
            slot_length.append(np.full(times, n))
            slot_bin.append(np.arange(first, first + times))
            slot_offset.append(np.full(times, offset))
            offset += n
        first += times
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    if len(lengths):
        slots = np.argsort(np.concatenate(slot_length), kind="stable")
        items = np.argsort(lengths, kind="stable")
        bins[items] = np.concatenate(slot_bin)[slots]
        offsets[items] = np.concatenate(slot_offset)[slots]
    return bins, offsets


def pack_pieces(pieces: DataFrame, size: int = 1024, group_rows: int = 1 << 17) -> DataFrame:
    """``pieces`` (any columns, one named length, in 1..size) with sequence_id and offset."""
    pieces = materialize(pieces, "pieces")
    groups = max(1, math.ceil(pieces.count() / group_rows))
    names = [f.name for f in pieces.schema.fields]
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64(*[c for c in names if c != "ids"]), F.lit(groups)))
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def pack(key, table):
        table = table.drop_columns(["__group"]).sort_by([(c, "ascending") for c in names if c != "ids"])
        bins, offsets = assign(table.column("length").to_numpy(), size)
        base = key[0].as_py() << 36
        return table.append_column("sequence_id", pa.array(bins + base)).append_column("offset", pa.array(offsets))

    return dealt.groupBy("__group").applyInArrow(pack, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, size: int = 1024, end_id: int = 2, with_ids: bool = False, group_rows: int = 1 << 17) -> DataFrame:
    """All documents as pieces with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(tokenize_pieces(docs, tokenizer, size, end_id, with_ids), size, group_rows)
