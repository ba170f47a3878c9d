"""One trial of a codec, in this process or in one of its own that time and memory limits can end.

Nothing here needs Spark, so that a trial's process starts in a moment: ``python -m gneiss.operators.trials``
reads a line of JSON and the data, and writes the outcome as JSON.
"""

from __future__ import annotations

import hashlib
import json
import lzma
import os
import subprocess
import sys
import time
import zlib
from concurrent.futures import ThreadPoolExecutor, wait
from functools import lru_cache

CHUNK = 1 << 20
#: Seconds between two looks at a trial's process.
PAUSE = 0.02
FIELDS = ("status", "input_bytes", "payload_bytes", "manifest_bytes", "output_bytes", "encode_seconds", "decode_seconds", "exact", "member_sha256", "error", "peak_rss_bytes")


class NotAvailable(Exception):
    """The codec's library isn't installed."""


def _chunks(data: bytes):
    for k in range(0, len(data), CHUNK):
        yield data[k : k + CHUNK]


@lru_cache(maxsize=8)
def _zstandard(method: str):
    """A compressor, kept for the next trial, and a decompressor."""
    try:
        import zstandard
    except ImportError as e:
        raise NotAvailable(method) from e
    return zstandard.ZstdCompressor(level=int(method[4:])), zstandard.ZstdDecompressor()


def compress(data: bytes, method: str) -> bytes:
    """``data`` in one stream of the method."""
    if method == "gzip9":
        packer = zlib.compressobj(9, zlib.DEFLATED, 31)
    elif method == "lzma2":
        # preset 6 with a dictionary no larger than its 8 MiB or the data: the tables of a larger one cost more than a small document
        own = {"id": lzma.FILTER_LZMA2, "preset": 6, "dict_size": min(1 << 23, max(1 << 12, len(data)))}
        packer = lzma.LZMACompressor(lzma.FORMAT_XZ, filters=[own])
    elif method.startswith("zstd"):
        packer = _zstandard(method)[0].compressobj(size=len(data))
    else:
        raise NotAvailable(method)
    return b"".join([*(packer.compress(c) for c in _chunks(data)), packer.flush()])


def decompress(data: bytes, method: str) -> bytes:
    """What ``compress`` was given."""
    if method == "gzip9":
        unpacker = zlib.decompressobj(31)
    elif method == "lzma2":
        unpacker = lzma.LZMADecompressor(lzma.FORMAT_XZ)
    elif method.startswith("zstd"):
        unpacker = _zstandard(method)[1].decompressobj()
    else:
        raise NotAvailable(method)
    return b"".join(unpacker.decompress(c) for c in _chunks(data))


def _without_output(status: str, data: bytes, manifest_bytes: int, error: str, peak: int | None = None) -> tuple:
    return status, len(data), None, manifest_bytes, None, None, None, False, None, error, peak


def trial(data: bytes, method: str, sizes: list[int], hashes: list[str], manifest_bytes: int = 0) -> tuple:
    """FIELDS of compressing, decompressing, cutting at the members' sizes and comparing each hash; a failure is an outcome, never raised."""
    try:
        t0 = time.perf_counter()
        packed = compress(data, method)
        t1 = time.perf_counter()
        again = decompress(packed, method)
        found, at = [], 0
        for n in sizes:
            found.append(hashlib.sha256(again[at : at + n]).hexdigest())
            at += n
        t2 = time.perf_counter()
        exact = at == len(again) and found == hashes
        return "ok" if exact else "mismatch", len(data), len(packed), manifest_bytes, len(packed) + manifest_bytes, t1 - t0, t2 - t1, exact, found, None, None
    except NotAvailable as e:
        return _without_output("not_available", data, manifest_bytes, str(e))
    except Exception as e:
        return _without_output("error", data, manifest_bytes, f"{type(e).__name__}: {e}")


def _resident(pid: int) -> int | None:
    """The most memory that a process has held, where the system tells."""
    try:
        with open(f"/proc/{pid}/status", encoding="ascii") as f:
            return next((int(line.split()[1]) * 1024 for line in f if line.startswith("VmHWM:")), None)
    except OSError:
        return None


def isolated(data: bytes, method: str, sizes: list[int], hashes: list[str], manifest_bytes: int = 0, seconds: float | None = None, rss_bytes: int | None = None) -> tuple:
    """``trial`` in a process of its own, with the most memory that it held.

    Beyond ``seconds`` the outcome is timeout, beyond ``rss_bytes`` resource_limit; a process that ends
    without an outcome is an error.
    """
    asked = json.dumps({"method": method, "sizes": sizes, "hashes": hashes, "manifest_bytes": manifest_bytes}).encode()
    env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
    child = subprocess.Popen([sys.executable, "-m", "gneiss.operators.trials"], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, env=env)
    peak, ended = None, None
    with ThreadPoolExecutor(1) as pool:
        told = pool.submit(child.communicate, asked + b"\n" + data)
        begin = time.monotonic()
        try:
            while not told.done() and not ended:
                peak = max(filter(None, (peak, _resident(child.pid))), default=None)
                if rss_bytes is not None and (peak or 0) > rss_bytes:
                    ended = "resource_limit", f"more than {rss_bytes} bytes of memory"
                elif seconds is not None and time.monotonic() - begin > seconds:
                    ended = "timeout", f"more than {seconds:g} seconds"
                else:
                    wait([told], PAUSE)
        finally:
            child.kill()  # nothing happens to a process that has ended
        out = told.result()[0]
    if ended:
        return _without_output(ended[0], data, manifest_bytes, ended[1], peak)
    if child.returncode or not out:
        return _without_output("error", data, manifest_bytes, f"the trial's process ended with {child.returncode}", peak)
    return (*json.loads(out)[:-1], peak)


def main() -> None:
    asked = json.loads(sys.stdin.buffer.readline())
    sys.stdout.write(json.dumps(trial(sys.stdin.buffer.read(), asked["method"], asked["sizes"], asked["hashes"], asked["manifest_bytes"])))


if __name__ == "__main__":
    main()
