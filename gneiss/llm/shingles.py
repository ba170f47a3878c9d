"""Word and shingle hashing over Arrow text buffers, without a Python loop per word.

Words are the runs of bytes other than space and tab..carriage return of the text with A-Z
lower-cased; a shingle is ``width`` consecutive words.  All hashes are 64-bit and the same on
every machine: words are hashed by a polynomial over a fixed byte table, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & ((1 << 64) - 1), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n+1 offsets of its rows in them; null rows are empty."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = 1 << 20):
    """(first row, rows) of consecutive parts of about ``most`` bytes, one row at least."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(size):
        if i > start and held + n > most:
            yield start, column.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(column):
        yield start, column.slice(start)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words; a word never crosses a row."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[data]
    step = np.diff(word)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    inner = np.unique(offsets[1:-1])
    inner = inner[(inner > 0) & (inner < len(data))]
    cut = inner[(word[inner] == 1) & (word[inner + 1] == 1)]  # rows that touch without a space
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes, equal for equal lower-cased words."""
    out = np.empty(len(starts), dtype=np.uint64)
    done = 0
    while done < len(starts):
        base = starts[done]
        stop = int(np.searchsorted(ends, base + _BLOCK, side="right"))
        if stop <= done:  # a word longer than a block
            h = 0
            for at in range(int(base), int(ends[done]), _BLOCK):
                part = _BYTES[data[at : min(at + _BLOCK, int(ends[done]))]]
                h = (h * 31 + int((part * _UP[: len(part)]).sum(dtype=np.uint64))) & ((1 << 64) - 1)
            out[done] = h
            done += 1
            continue
        part = _BYTES[data[base : ends[stop - 1]]]
        total = np.empty(len(part) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(part * _UP[: len(part)], out=total[1:])
        s, e = starts[done:stop] - base, ends[done:stop] - base
        out[done:stop] = (total[e] - total[s]) * _DOWN[s] + (e - s).astype(np.uint64)
        done = stop
    return mix(out)


def texts(batches, most: int = 1 << 20, at: int = 1):
    """Batches cut into parts whose column ``at``, texts or bytes, has about ``most`` bytes, one row at least.

    Spark itself bounds the bytes of a batch; these parts bound what is made of it at once.
    """
    for batch in batches:
        for start, part in slices(batch.column(at), most):
            yield batch.slice(start, len(part))


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and the n+1 bounds of the rows.

    A row with fewer than ``width`` words, but one at least, has one shingle: its whole sequence.
    """
    data, offsets = text_buffer(column)
    rows = len(offsets) - 1
    starts, ends = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets, side="left")  # of each row's words
    count = np.diff(first)
    n = len(words)
    if n >= width:
        shingles = np.full(n - width + 1, width, dtype=np.uint64)
        for k in range(width):
            shingles = mix(shingles + words[k : n - width + 1 + k])
    else:
        shingles = np.zeros(0, np.uint64)
    parts, bounds = [], np.zeros(rows + 1, dtype=np.int64)
    for i in range(rows):
        c = count[i]
        if c >= width:
            own = np.sort(shingles[first[i] : first[i] + c - width + 1])
            keep = np.empty(len(own), dtype=bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif c:
            h = np.array([c], dtype=np.uint64)
            for k in range(c):
                h = mix(h + words[first[i] + k])
            own = h
        else:
            own = shingles[:0]
        parts.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds
