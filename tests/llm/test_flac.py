"""FLAC streams: exact round trips, checks that fail, and seeking."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from gneiss.llm import flac


def payloads():
    r = random.Random(2)
    return [
        flac.payload(None)[0],
        flac.payload("a")[0],
        flac.payload("é" * 999)[0],
        bytes(r.randrange(256) for _ in range(64 * 33)),
        bytes([7]) * 6400,
        bytes([0, 255] * 640),
        bytes(int(128 + 100 * np.sin(k / 9)) for k in range(64 * 50)),
        b"words and more words. " * 640,
    ]


def test_round_trip():
    own = [p + bytes(-len(p) % 64) for p in payloads()]
    streams = flac.encode(own)
    assert [(x + 128).astype(np.uint8).tobytes() for x in flac.decode(streams)] == own
    assert len(streams[4]) < 400 and len(streams[6]) < 0.8 * len(own[6])  # constant and predictable samples
    assert flac.encode(own) == streams


def test_without_seek_table():
    own = flac.payload("some words to store " * 300)[0]
    stream = flac.encode([own])[0]
    s = flac.parse(stream)
    bare = stream[:4] + b"\x80" + stream[5:42] + stream[s.audio :]
    assert not flac.parse(bare).points
    assert (flac.decode([bare])[0] == flac.decode([stream])[0]).all()


def test_seek():
    stream = flac.encode([flac.payload("some words to store " * 500)[0]])[0]
    whole = flac.decode([stream])[0]
    for start, count in ((0, 10), (1000, 3000), (5000, 10**6), (1024, 1024), (10**6, 5)):
        assert flac.read_samples(stream, start, count).tolist() == whole[start : start + count].tolist()


@pytest.mark.parametrize("at", [-1, -20, -700, 60])
def test_damage(at):
    stream = bytearray(flac.encode([flac.payload("some words to store " * 300)[0]])[0])
    at = at if at < 0 else flac.parse(bytes(stream)).audio + 2
    stream[at] ^= 4
    with pytest.raises(ValueError):
        flac.decode([bytes(stream)])


def test_header_numbers():
    for n in (0, 127, 128, 2047, 2048, 65535, 65536, 10**6):
        h = flac._header(n, 64)
        assert flac._frame_header(h, 0, 8)[:2] == (64, n)


def test_tables(spark):
    df = spark.createDataFrame([(1, "one two", 1), (1, "one two", 1), (2, None, 2), (3, "x" * 10000, 3)], "doc_id long, text string, media int")
    got = {r.doc_id: r for r in flac.round_trip(df).collect()}
    padded = b"one two".ljust(64, b"\0")
    assert (got[1].n_bytes, got[1].payload_bytes, got[1].payload_sha256, got[1].tail_crc32) == (7, 64, hashlib.sha256(padded).hexdigest(), zlib.crc32(padded))
    assert got[2].payload_sha256 == hashlib.sha256(bytes(64)).hexdigest() and got[2].n_bytes == 0
    media = flac.encode_texts(df)
    assert {r.doc_id: hashlib.sha256(r.media).hexdigest() for r in media.collect()} == {k: r.media_sha256 for k, r in got.items()}
    blocks = flac.decode_blocks(media.where("doc_id = 3")).orderBy("block").collect()
    assert [b.sample_offset for b in blocks] == [0, 4096, 8192] and b"".join(bytes(b.pcm) for b in blocks) == bytes((np.frombuffer(b"x" * 10000 + bytes(48), np.uint8) ^ 0x80))
    assert flac.round_trip(df.limit(0)).count() == 0


class Bits:
    """Bits one after the other."""

    def __init__(self):
        self.s = ""

    def put(self, value: int, n: int) -> None:
        self.s += format(value & ((1 << n) - 1), f"0{n}b") if n else ""

    def bytes(self) -> bytes:
        s = self.s + "0" * (-len(self.s) % 8)
        return int(s, 2).to_bytes(len(s) // 8, "big")


def crc(data: bytes, poly: int, width: int) -> int:
    out = 0
    for b in data:
        out ^= b << width - 8
        for _ in range(8):
            out = (out << 1 ^ (poly if out >> width - 1 & 1 else 0)) & ((1 << width) - 1)
    return out


FIXED = {0: [], 1: [1], 2: [2, -1], 3: [3, -3, 1], 4: [4, -6, 4, -1]}


def foreign_frame(x: list[int], number: int, kind: str, taps: list[int], shift: int = 0, parameters=(2,), method: int = 0, blocksize: int = 6) -> bytes:
    """A frame by the format's definition; a parameter of None is an escaped partition of 9 bits."""
    head = Bits()
    head.put(0xFFF8, 16)
    head.put(blocksize, 4)
    head.put(0, 8)  # rate as in the stream, mono
    head.put(1, 3)
    head.put(0, 1)
    for b in chr(number).encode():
        head.put(b, 8)
    head.put(len(x) - 1, 8 * (blocksize - 5))
    top = head.bytes()
    out, order = Bits(), len(taps)
    out.put({"constant": 0, "verbatim": 1, "fixed": 8 + order, "lpc": 31 + order}[kind] << 1, 8)
    if kind in ("constant", "verbatim"):
        for v in x[:1] if kind == "constant" else x:
            out.put(v, 8)
    else:
        for v in x[:order]:
            out.put(v, 8)
        if kind == "lpc":
            out.put(12 - 1, 4)
            out.put(shift, 5)
            for c in taps:
                out.put(c, 12)
        left = [x[t] - (sum(c * x[t - 1 - j] for j, c in enumerate(taps)) >> shift) for t in range(order, len(x))]
        out.put(method, 2)
        out.put(len(parameters).bit_length() - 1, 4)
        part = len(x) // len(parameters)
        for i, k in enumerate(parameters):
            wide = 4 + method
            out.put((1 << wide) - 1 if k is None else k, wide)
            if k is None:
                out.put(9, 5)
            for r in left[max(0, i * part - order) : (i + 1) * part - order]:
                u = 2 * r if r >= 0 else -2 * r - 1
                if k is None:
                    out.put(r, 9)
                else:
                    out.s += "0" * (u >> k) + "1"
                    out.put(u, k)
    body = top + bytes([crc(top, 7, 8)]) + out.bytes()
    return body + crc(body, 0x8005, 16).to_bytes(2, "big")


def foreign(blocks: list[tuple]) -> tuple[bytes, list[int]]:
    """A stream without a seek table, with blocks that no decoder needs, and its samples."""
    samples = [v for b in blocks for v in b[0]]
    info = Bits()
    for value, n in ((16, 16), (16, 16), (0, 24), (0, 24), (8000, 20), (0, 3), (7, 5), (len(samples), 36)):
        info.put(value, n)
    md5 = hashlib.md5(bytes(v & 255 for v in samples)).digest()
    metadata = b"\x00\x00\x00\x22" + info.bytes() + md5 + b"\x04\x00\x00\x08" + bytes(8) + b"\x81\x00\x00\x05" + bytes(5)
    return b"fLaC" + metadata + b"".join(foreign_frame(b[0], i, *b[1:-1], **b[-1]) for i, b in enumerate(blocks)), samples


def test_foreign_streams():
    """Streams that another encoder wrote: all kinds of subframes, partitions, escapes and frame numbers of two bytes."""
    r = random.Random(5)

    def walk(n):
        out, v = [], 0
        for _ in range(n):
            v = max(-100, min(100, v + r.randrange(-9, 10)))
            out.append(v)
        return out

    blocks = [([5] * 16, "constant", [], {}), (walk(16), "verbatim", [], {"blocksize": 7})]
    for order, taps in FIXED.items():
        blocks += [(walk(16), "fixed", taps, {"parameters": p, "method": m}) for p in ((3,), (0, 4), (2, None), (None, 1, 5, 3)) for m in (0, 1)]
        assert order == len(taps)
    blocks += [(walk(16), "lpc", taps, {"shift": s, "parameters": p}) for taps, s in (([2000], 11), ([1500, -700, 90], 9), ([300, 5, -9, 44, -2047, 2047, 0, 31], 10)) for p in ((4,), (3, 6), (None,))]
    blocks += [(walk(16), "lpc", list(range(16)), {"shift": 4, "parameters": (7,)})]  # as many taps as samples
    blocks += [([127, -128] * 8, "fixed", FIXED[4], {"parameters": (0,)})]  # long runs of zeros
    r.shuffle(blocks)
    blocks = blocks * 3 + [(walk(4), "fixed", FIXED[4], {"parameters": (3,)})]
    assert len(blocks) > 128
    stream, samples = foreign(blocks)
    assert flac.decode([stream])[0].tolist() == samples
    assert [x.tolist() for x in flac.decode([stream] * 2)] == [samples] * 2
    assert flac.read_samples(stream, 100, 50).tolist() == samples[100:150]
