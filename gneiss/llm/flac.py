"""FLAC streams as a media column: numpy encoder and decoder that work on many frames at once.

The samples of a text are its UTF-8 bytes, zero-padded to a positive multiple of 64, as 8-bit signed
samples (byte - 128), mono.  A stream has a STREAMINFO block with the MD5 sum, a SEEKTABLE with one
point a frame, and frames of ``BLOCK`` samples: fixed or linear prediction with Rice-coded residuals
in four partitions, or a constant or verbatim subframe where that is smaller.

The decoder starts at all frames that the seek table names, reads one residual of every frame at a
time, undoes the predictors, and checks CRC-8 of each header, CRC-16 of each frame and the MD5 sum.
Streams without a full seek table are read frame after frame.

Defined results: null and empty texts are 64 zero bytes; equal texts give equal streams; an empty
table gives no rows; columns other than the two named are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gneiss.llm.shingles import texts


BLOCK = 1024
FRAMES = 2048
ORDER, PRECISION, PARTITIONS = 4, 12, 4
RATE = 8000


def _crc_table(poly: int, bits: int) -> np.ndarray:
    out = []
    for i in range(256):
        r = i << (bits - 8)
        for _ in range(8):
            r = r << 1 ^ (poly if r >> (bits - 1) & 1 else 0)
        out.append(r & ((1 << bits) - 1))
    return np.array(out, dtype=np.uint16)


_CRC8, _CRC16 = _crc_table(0x07, 8).tolist(), _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    r = 0
    for b in data:
        r = _CRC8[r ^ b]
    return r


def crc16(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-16 of each of the given slices."""
    order = np.argsort(-sizes, kind="stable")
    at, size = starts[order], sizes[order]
    live = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
    r = np.zeros(len(at), dtype=np.uint16)
    for p, n in enumerate(live):
        r[:n] = _CRC16[(r[:n] >> 8) ^ buffer[at[:n] + p]] ^ (r[:n] << 8)
    out = np.empty_like(r)
    out[order] = r
    return out


def _number(n: int) -> bytes:
    """A frame number in the extended UTF-8 form."""
    if n < 0x80:
        return bytes([n])
    tail = []
    room = 0x3F
    while n > room:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        room >>= 1
    return bytes([(~room << 1) & 0xFF | n, *reversed(tail)])


def _header(number: int, n: int) -> bytes:
    code = 10 if n == BLOCK == 1024 else 7
    out = bytes([0xFF, 0xF8, code << 4 | 4, 0 << 4 | 1 << 1]) + _number(number)
    if code == 7:
        out += struct.pack(">H", n - 1)
    return out + bytes([crc8(out)])


def _predictors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (frames x ORDER) and shifts by Levinson's recursion."""
    f = x.astype(np.float32)
    r = np.stack([np.einsum("ft,ft->f", f[:, k:], f[:, : f.shape[1] - k]) for k in range(ORDER + 1)], axis=1).astype(np.float64)
    a = np.zeros((len(f), ORDER))
    error = r[:, 0] * (1 + 1e-9) + 1e-9
    for i in range(ORDER):
        k = (r[:, i + 1] - (a[:, :i] * r[:, i:0:-1]).sum(axis=1)) / error
        a[:, :i] -= k[:, None] * a[:, i - 1 :: -1][:, :i] if i else 0
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    largest = np.maximum(np.abs(a).max(axis=1), 2.0**-10)
    shift = np.clip(PRECISION - 1 - np.ceil(np.log2(largest + 1e-12)), 0, 15).astype(np.int32)
    q = np.clip(np.rint(a * (1 << shift)[:, None]), -(1 << PRECISION - 1), (1 << PRECISION - 1) - 1).astype(np.int32)
    return q, shift


class _Bits:
    """Fields to be written at absolute bit ends into one buffer; fields never overlap."""

    def __init__(self):
        self.ends, self.values = [], []

    def put(self, ends: np.ndarray, values: np.ndarray) -> None:
        self.ends.append(ends.ravel())
        self.values.append(values.ravel())

    def bytes(self, size: int) -> np.ndarray:
        ends, values = np.concatenate(self.ends), np.concatenate(self.values).astype(np.int64)
        last, values = (ends - 1) >> 3, values << (-ends & 7)
        out = np.zeros(size, dtype=np.float64)
        while len(values):
            out += np.bincount(last, weights=values & 255, minlength=size)
            values >>= 8
            more = values > 0
            last, values = last[more] - 1, values[more]
        return out.astype(np.uint8)


def _encode_frames(x: np.ndarray, n: np.ndarray, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of frames over the rows of x (int32, zero beyond n samples), and their n+1 bounds."""
    frames, width = x.shape
    t = np.arange(width)
    valid = t < n[:, None]
    fixed = [x]
    for o in range(1, 5):
        nxt = np.zeros_like(x)
        nxt[:, o:] = fixed[-1][:, o:] - fixed[-1][:, o - 1 : -1]
        fixed.append(nxt)
    q, shift = _predictors(x)
    linear = np.zeros_like(x)
    for j in range(ORDER):
        linear[:, ORDER:] += q[:, j : j + 1] * x[:, ORDER - 1 - j : width - 1 - j]
    linear = x - (linear >> shift[:, None])
    linear[:, :ORDER] = 0
    cost = np.stack([np.abs(r).sum(axis=1) for r in [*fixed, linear]])  # with the padding's few steps
    kind = cost.argmin(axis=0)
    order = np.where(kind == 5, ORDER, kind)
    residual = np.select([(kind == k)[:, None] for k in range(6)], [*fixed, linear])
    live = valid & (t >= order[:, None])
    u = np.where(live, residual << 1 ^ residual >> 31, 0)
    part = n // PARTITIONS
    sums = np.zeros((frames, width + 1), dtype=np.int64)
    np.cumsum(u, axis=1, out=sums[:, 1:])
    edges = part[:, None] * np.arange(PARTITIONS + 1)
    held = np.take_along_axis(sums, edges, axis=1)
    count = np.diff(edges, axis=1)
    count[:, 0] -= order
    mean = np.diff(held, axis=1) / np.maximum(count, 1)
    rice = np.clip(np.rint(np.log2(mean * math.log(2) + 0.25)), 0, 14).astype(np.int32)
    own = np.minimum(t // part[:, None], PARTITIONS - 1)
    k = np.take_along_axis(rice, own, axis=1)
    bits = np.where(live, (u >> k) + 1 + k, 0)
    ends = np.cumsum(bits, axis=1) + 4 * (own + 1)
    before = 8 + 8 * order + np.where(kind == 5, 9 + PRECISION * ORDER, 0) + 6
    body = before + ends[np.arange(frames), n - 1]
    constant = (np.abs(fixed[1]) * (valid & (t >= 1))).sum(axis=1) == 0
    verbatim = ~constant & (body > 8 + 8 * n)
    coded = ~constant & ~verbatim
    body = np.where(constant, 16, np.where(verbatim, 8 + 8 * n, body))
    heads = [_header(i, m) for i, m in zip(numbers, n.tolist(), strict=True)]
    head = np.array([len(h) for h in heads])
    sizes = head + (body + 7) // 8 + 2
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    at = (bounds[:-1] + head) * 8  # the first bit of each subframe
    out = _Bits()
    out.put(at + 7, np.select([constant, verbatim, kind < 5], [0, 1, 8 | order], 32 | ORDER - 1))
    plain = np.where(constant, 1, np.where(verbatim, n, order))  # samples that are written as they are
    f, s = np.nonzero(t < plain[:, None])
    out.put(at[f] + 8 + 8 * (s + 1), x[f, s] & 255)
    lpc = np.flatnonzero(coded & (kind == 5))
    if len(lpc):
        here = at[lpc] + 8 + 8 * ORDER
        out.put(here + 9, (PRECISION - 1) << 5 | shift[lpc])
        out.put(here[:, None] + 9 + PRECISION * np.arange(1, ORDER + 1), q[lpc] & ((1 << PRECISION) - 1))
    c = np.flatnonzero(coded)
    if len(c):
        out.put(at[c] + before[c], np.full(len(c), PARTITIONS.bit_length() - 1))
        here = at[c] + before[c]
        first = np.take_along_axis(ends[c], edges[c, :-1], axis=1) - np.take_along_axis(bits[c], edges[c, :-1], axis=1)
        out.put(here[:, None] + first, rice[c])
        f, s = np.nonzero(live[c])
        g = c[f]
        kk = k[g, s]
        out.put(here[f] + ends[g, s], 1 << kk | u[g, s] & ((1 << kk) - 1))
    buffer = out.bytes(int(bounds[-1]))
    raw = np.frombuffer(b"".join(heads), np.uint8)
    buffer[np.repeat(bounds[:-1] - (np.cumsum(head) - head), head) + np.arange(len(raw))] = raw
    check = crc16(buffer, bounds[:-1], sizes - 2)
    buffer[bounds[1:] - 2], buffer[bounds[1:] - 1] = check >> 8, check & 255
    return buffer, bounds


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload (a positive multiple of 64 bytes)."""
    jobs = [(i, k, p) for i, p in enumerate(payloads) for k in range(-(-len(p) // BLOCK))]
    frames: list[list[bytes]] = [[] for _ in payloads]
    for lo in range(0, len(jobs), FRAMES):
        now = jobs[lo : lo + FRAMES]
        x = np.zeros((len(now), BLOCK), dtype=np.int32)
        n = np.zeros(len(now), dtype=np.int64)
        for r, (_, k, p) in enumerate(now):
            own = np.frombuffer(p, np.uint8, min(BLOCK, len(p) - k * BLOCK), k * BLOCK)
            x[r, : len(own)] = own
            x[r, : len(own)] -= 128
            n[r] = len(own)
        buffer, bounds = _encode_frames(x, n, [k for _, k, _ in now])
        raw = buffer.tobytes()
        for r, (i, _, _) in enumerate(now):
            frames[i].append(raw[bounds[r] : bounds[r + 1]])
    out = []
    for p, own in zip(payloads, frames, strict=True):
        signed = (np.frombuffer(p, np.uint8) ^ 0x80).tobytes()
        sizes = [len(x) for x in own]
        info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big")
        info += (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big") + hashlib.md5(signed, usedforsecurity=False).digest()
        offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist()
        seek = b"".join(struct.pack(">QQH", k * BLOCK, o, min(BLOCK, len(p) - k * BLOCK)) for k, o in enumerate(offsets))
        # 24 bits hold the size of a block: beyond 932,000 frames the table names every m-th frame only
        step = -(-len(seek) // (18 * 930_000)) or 1
        if step > 1:
            seek = b"".join(seek[18 * k : 18 * k + 18] for k in range(0, len(own), step))
        out.append(b"".join([b"fLaC", b"\x00", (34).to_bytes(3, "big"), info, b"\x83", len(seek).to_bytes(3, "big"), seek, *own]))
    return out


@dataclass
class Stream:
    """What the metadata blocks of a stream say; points: (first sample, byte offset, samples)."""

    data: bytes
    block: int
    bits: int
    samples: int
    md5: bytes
    audio: int
    points: list[tuple[int, int, int]]

    @property
    def indexed(self) -> bool:
        """Whether the seek table names every frame."""
        return len(self.points) == -(-self.samples // self.block)


def parse(data: bytes) -> Stream:
    """The metadata of a stream; ValueError if it is no mono stream of at most 16 bits."""
    if data[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, last, info, points = 4, False, b"", []
    while not last:
        last, kind, size = data[at] >> 7, data[at] & 127, int.from_bytes(data[at + 1 : at + 4], "big")
        own = data[at + 4 : at + 4 + size]
        at += 4 + size
        if kind == 0:
            info = own
        elif kind == 3:
            points = [p for p in struct.iter_unpack(">QQH", own) if p[0] != 2**64 - 1]
    word = int.from_bytes(info[10:18], "big")
    if word >> 41 & 7 or (word >> 36 & 31) > 15:
        raise ValueError("only mono streams of up to 16 bits are read")
    return Stream(data, struct.unpack(">H", info[2:4])[0], (word >> 36 & 31) + 1, word & ((1 << 36) - 1), info[18:34], at, points)


_SIZES = {1: 192, **{k: 576 << k - 2 for k in range(2, 6)}, **{k: 256 << k - 8 for k in range(8, 16)}}


def _frame_header(data, at: int, bits: int) -> tuple[int, int, int]:
    """(samples, frame or sample number, bytes) of the frame header at ``at``."""
    if data[at] != 0xFF or data[at + 1] & 0xFE != 0xF8:
        raise ValueError("a frame doesn't start where it should")
    size, rate, channels, depth = data[at + 2] >> 4, data[at + 2] & 15, data[at + 3] >> 4, data[at + 3] >> 1 & 7
    if channels or depth not in (0, 1, 4) or depth and {1: 8, 4: 16}[depth] != bits:
        raise ValueError("a frame's format differs from the stream's")
    p = at + 4
    first = data[p]
    more = 0 if first < 0x80 else 8 - (first ^ 0xFF).bit_length() - 1
    number = first if not more else first & (0x3F >> more)
    for b in data[p + 1 : p + 1 + more]:
        number = number << 6 | b & 0x3F
    p += 1 + more
    if size in (6, 7):
        n = int.from_bytes(data[p : p + size - 5], "big") + 1
        p += size - 5
    else:
        n = _SIZES[size]
    p += {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if crc8(data[at:p]) != data[p]:
        raise ValueError("a frame header's checksum is wrong")
    return n, number, p + 1 - at


_ZEROS = np.array([16] + [16 - i.bit_length() for i in range(1, 1 << 16)], dtype=np.int64)


def _take(words: np.ndarray, at: np.ndarray, bits) -> np.ndarray:
    """Unsigned numbers of ``bits`` (1 to 32) bits at bit positions."""
    return ((words[at >> 3] << (at & 7).astype(np.uint64)) >> (64 - np.asarray(bits)).astype(np.uint64)).astype(np.int64)


def _sign(x: np.ndarray, bits) -> np.ndarray:
    return x - ((x >> (np.asarray(bits) - 1) & 1) << bits)


def _decode_frames(raw: bytes, starts: list[int], bits: int) -> tuple[list[np.ndarray], list[int]]:
    """Samples (int32) of the frames at the byte offsets, and the offsets behind them."""
    heads = [_frame_header(raw, s, bits) for s in starts]
    buffer = np.frombuffer(raw, np.uint8)
    wide = np.zeros(len(buffer) + 16, dtype=np.uint64)
    wide[: len(buffer)] = buffer
    words = np.zeros(len(buffer) + 8, dtype=np.uint64)
    for j in range(8):
        words |= wide[j : j + len(words)] << np.uint64(56 - 8 * j)
    n = np.array([h[0] for h in heads], dtype=np.int64)
    at = np.array([s + h[2] for s, h in zip(starts, heads, strict=True)], dtype=np.int64) * 8
    kind = _take(words, at, 8)
    if (kind & 0x81).any():
        raise ValueError("a subframe header that isn't read: wasted bits or padding")
    kind >>= 1
    at += 8
    fixed, lpc = (kind >= 8) & (kind <= 12), kind >= 32
    if not (fixed | lpc | (kind <= 1)).all():
        raise ValueError("a reserved subframe type")
    order = np.where(fixed, kind - 8, np.where(lpc, kind - 31, 0))
    frames, width = len(n), int(n.max())
    out = np.zeros((width, frames), dtype=np.int64)  # a row for each sample: the loops below write whole rows
    plain = np.select([kind == 0, kind == 1], [1, n], order)
    for p in range(int(plain.max(initial=0))):
        f = np.flatnonzero(plain > p)
        out[p, f] = _sign(_take(words, at[f], bits), bits)
        at[f] += bits
    same = np.flatnonzero(kind == 0)
    out[:, same] = out[0, same]
    coefficients = np.zeros((32, frames), dtype=np.int64)
    shift = np.zeros(frames, dtype=np.int64)
    f = np.flatnonzero(lpc)
    if len(f):
        precision = _take(words, at[f], 4) + 1
        shift[f] = _sign(_take(words, at[f] + 4, 5), 5)
        at[f] += 9
        for j in range(int(order[f].max())):
            g = order[f] > j
            coefficients[j, f[g]] = _sign(_take(words, at[f[g]], precision[g]), precision[g])
            at[f[g]] += precision[g]
    coded = np.flatnonzero(fixed | lpc)
    if len(coded):
        coded = coded[np.argsort(order[coded] - n[coded], kind="stable")]  # longest first
        at[coded] = _residuals(words, at[coded], n[coded], order[coded], coded, out)
        _integrate(out, order, fixed, lpc, coefficients, shift)
    ends = (at + 7) >> 3
    begun = np.array(starts, dtype=np.int64)
    check = crc16(buffer, begun, ends - begun)
    if (check != (buffer[ends].astype(np.uint16) << 8 | buffer[ends + 1])).any():
        raise ValueError("a frame's checksum is wrong")
    return [out[: n[i], i] for i in range(frames)], (ends + 2).tolist()


def _residuals(words, at, n, order, column, out) -> np.ndarray:
    """Read the residuals of all frames (longest first), one of each at a time; the bit behind each."""
    method, depth = _take(words, at, 2), _take(words, at + 2, 4)
    if (method > 1).any():
        raise ValueError("a reserved residual coding")
    wide = 4 + method  # bits of a Rice parameter
    at = at + 6
    left, part = n - order, n >> depth
    rice, escape = np.zeros(len(at), np.int64), np.full(len(at), -1, np.int64)
    turn = part - order  # residuals before the next partition
    empty = np.flatnonzero(turn == 0)  # a first partition without residuals has its parameter all the same
    first = _take(words, at[empty], wide[empty])
    at[empty] += wide[empty] + np.where(first == (1 << wide[empty]) - 1, 5, 0)
    turn[empty] = part[empty]
    turns = np.zeros(len(at), np.int64)  # where the current partition began
    live = np.searchsorted(-left, -np.arange(int(left[0])), side="left")
    due = np.zeros(len(at), np.int64)
    next_due = 0
    for i, a in enumerate(live):
        if i == next_due:
            g = np.flatnonzero(due[:a] == i)
            rice[g] = _take(words, at[g], wide[g])
            at[g] += wide[g]
            raw = rice[g] == (1 << wide[g]) - 1
            escape[g] = -1
            if raw.any():
                e = g[raw]
                escape[e] = _take(words, at[e], 5)
                at[e] += 5
            turns[g] = i
            due[g] = i + np.where(turns[g] == 0, turn[g], part[g])
            next_due = int(due[:a].min())
            escaped = bool((escape[:a] >= 0).any())
        p, k = at[:a], rice[:a]
        v = words[p >> 3] << (p & 7).astype(np.uint64)
        q = _ZEROS[(v >> np.uint64(48)).astype(np.int64)]
        skip = q
        if (q == 16).any():
            q = q.copy()
            for r in np.flatnonzero(q == 16):
                if escape[r] < 0:
                    while True:
                        x = int(words[(int(p[r]) + int(q[r])) >> 3] << np.uint64((int(p[r]) + int(q[r])) & 7)) >> 8
                        if x:
                            q[r] += 56 - x.bit_length()
                            break
                        q[r] += 48
            skip = q
            v = words[(p + skip) >> 3] << ((p + skip) & 7).astype(np.uint64)
            low = ((v << np.uint64(1)) >> np.uint64(1) >> (63 - k).astype(np.uint64)).astype(np.int64)
        else:
            low = ((v << (q + 1).astype(np.uint64)) >> np.uint64(1) >> (63 - k).astype(np.uint64)).astype(np.int64)
        u = q << k | low
        value = u >> 1 ^ -(u & 1)
        used = skip + 1 + k
        if escaped:
            e = np.flatnonzero(escape[:a] >= 0)
            size = escape[e]
            value[e] = np.where(size == 0, 0, _sign(_take(words, p[e], np.maximum(size, 1)), np.maximum(size, 1)))
            used[e] = size
        out[i + order[:a], column[:a]] = value
        at[:a] += used
    return at


def _integrate(out, order, fixed, lpc, coefficients, shift) -> None:
    """Turn residuals behind the warm-up samples into samples, in place."""
    for o in range(1, 5):
        f = np.flatnonzero(fixed & (order == o))
        if not len(f):
            continue
        own = out[:, f]
        seeds = [own[:o]]
        for _ in range(o - 1):
            seeds.append(np.diff(seeds[-1], axis=0))
        own = own[o:]
        for level in range(o - 1, -1, -1):
            own = np.cumsum(own, axis=0) + seeds[level][-1]
        out[o:, f] = own
    for o in np.unique(order[lpc]):
        f = np.flatnonzero(lpc & (order == o))
        own, c, s = np.ascontiguousarray(out[:, f]), coefficients[:o, f][::-1].copy(), shift[f]
        for t in range(o, len(own)):
            own[t] += (c * own[t - o : t]).sum(axis=0) >> s
        out[:, f] = own


def decode(streams: list[bytes]) -> list[np.ndarray]:
    """Samples (int32) of each stream; ValueError if a checksum is wrong."""
    parsed = [parse(x) for x in streams]
    out: list[list[np.ndarray]] = [[] for _ in streams]
    ready = [(i, s.audio + o) for i, s in enumerate(parsed) if s.indexed for _, o, _ in s.points]
    for lo in range(0, len(ready), FRAMES):
        now = ready[lo : lo + FRAMES]
        used = sorted({i for i, _ in now})
        base, cuts, size = {}, [], 0
        for i in used:  # only the part of a long stream that holds these frames
            own = [p for j, p in now if j == i]
            more = [p for j, p in ready[lo + FRAMES : lo + FRAMES + 1] if j == i]
            base[i] = size - own[0]
            cuts.append(streams[i][own[0] : more[0] if more else len(streams[i])])
            size += len(cuts[-1])
        samples, _ = _decode_frames(b"".join(cuts), [p + base[i] for i, p in now], 8 if all(parsed[i].bits == 8 for i in used) else _one_depth(parsed, used))
        for (i, _), s in zip(now, samples, strict=True):
            out[i].append(s)
    for i, s in enumerate(parsed):
        if not s.indexed:
            at, done, size = s.audio, 0, 16 * s.block + 64
            while done < s.samples:
                cut = s.data[at : at + size]  # a frame is seldom larger than its samples by much
                try:
                    (own,), (used,) = _decode_frames(cut, [0], s.bits)
                except (IndexError, ValueError):
                    if at + size >= len(s.data):
                        raise
                    size *= 4
                    continue
                out[i].append(own)
                at, done = at + used, done + len(own)
    result = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
    for s, own in zip(parsed, result, strict=True):
        raw = own.astype("i1" if s.bits <= 8 else "<i2").tobytes()
        if len(own) != s.samples or any(s.md5) and hashlib.md5(raw, usedforsecurity=False).digest() != s.md5:
            raise ValueError("the samples don't have the stream's checksum")
    return result


def _one_depth(parsed: list[Stream], used: list[int]) -> int:
    depths = {parsed[i].bits for i in used}
    if len(depths) > 1:
        raise ValueError("streams of one call must have one sample size")
    return depths.pop()


def read_samples(data: bytes, start: int, count: int) -> np.ndarray:
    """``count`` samples from ``start`` on: only the frames that hold them are decoded, all if no seek table names them."""
    s = parse(data)
    stop = min(start + count, s.samples)
    if start >= stop:
        return np.zeros(0, np.int64)
    if not s.indexed:
        return decode([data])[0][start:stop]
    held = [(first, o) for first, o, n in s.points if first < stop and first + n > start]
    own, _ = _decode_frames(data, [s.audio + o for _, o in held], s.bits)
    joined = np.concatenate(own)
    return joined[start - held[0][0] : stop - held[0][0]]


def payload(text: str | None) -> tuple[bytes, int]:
    """The padded UTF-8 bytes of a text and their number before padding."""
    raw = (text or "").encode()
    return raw + bytes(-len(raw) % 64 or (0 if raw else 64)), len(raw)


def features(samples: np.ndarray) -> str:
    """Mean level, energy and zero crossings of the samples, as text."""
    n = max(1, len(samples))
    sums, squares = int(samples.sum()), int((samples * samples).sum())
    crossings = int(((samples[1:] < 0) != (samples[:-1] < 0)).sum())
    return f"mean={sums / n:.6f};energy={squares / n:.6f};crossings={crossings};peak={int(np.abs(samples).max(initial=0))}"


def encode_texts(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the stream of every text (media)."""
    docs = docs.select("doc_id", "text")

    def run(batches):
        for batch in texts(batches):
            made = [payload(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n in made], pa.int64()), pa.array(encode([p for p, _ in made]), pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, media binary")


def decode_blocks(media: DataFrame, block: int = 4096) -> DataFrame:
    """PCM blocks of every stream: doc_id, block, sample_offset, samples, pcm (null media: none)."""
    media = media.select("doc_id", "media")

    def run(batches):
        for batch in texts(batches):
            ids, streams = batch.column(0), batch.column(1).to_pylist()
            held = [i for i, s in enumerate(streams) if s is not None]
            rows = [(i, k // block, k, own[k : k + block]) for i, own in zip(held, decode([streams[i] for i in held]), strict=True) for k in range(0, len(own), block)]
            pcm = [own.astype("i1").tobytes() if parse(streams[i]).bits <= 8 else own.astype("<i2").tobytes() for i, _, _, own in rows]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([len(r[3]) for r in rows], pa.int64()), pa.array(pcm, pa.binary())],
                ["doc_id", "block", "sample_offset", "samples", "pcm"],
            )

    return media.mapInArrow(run, f"doc_id {media.schema['doc_id'].dataType.simpleString()}, block bigint, sample_offset bigint, samples bigint, pcm binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """encode_texts and decode in one pass, as digests of what was stored and of what was read back."""
    docs = docs.select("doc_id", "text")
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches):
        for batch in texts(batches):
            made = [payload(t) for t in batch.column(1).to_pylist()]
            streams = encode([p for p, _ in made])
            read = decode(streams)
            raw = [(s + 128).astype(np.uint8).tobytes() for s in read]
            columns = [
                pa.array([n for _, n in made], pa.int64()),
                pa.array([len(r) for r in raw], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raw], pa.string()),
                pa.array([zlib.crc32(r[-64:]) for r in raw], pa.int64()),
                pa.array([len(s) for s in streams], pa.int64()),
                pa.array([hashlib.sha256(s).hexdigest() for s in streams], pa.string()),
                pa.array([features(s) for s in read], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
