"""The client without a network, and trials in processes of their own."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime

import pytest

from gneiss.operators import codecs, trials
from gneiss.sources.client import Client, Failed, Refused, Response, capture, wait_seconds


def made(answers, **options):
    """A client that gets ``answers`` (url -> list of responses, the last one again and again), with its requests and waits."""
    asked, waits = [], []

    def send(url, headers, timeout):
        asked.append(url)
        rest = answers.get(url, [Response(404)])
        got = rest.pop(0) if len(rest) > 1 else rest[0]
        if isinstance(got, Exception):
            raise got
        return got

    return Client("tester", send=send, sleep=waits.append, clock=lambda: 0.0, **{"delay": 0, **options}), asked, waits


@pytest.mark.parametrize("status", [429, 500, 503])
def test_tries_again(status):
    client, asked, waits = made({"https://a/x": [Response(status, headers={"retry-after": "7"}), Response(200, b"fine")]}, retries=1)
    assert client.get("https://a/x").content == b"fine"
    assert asked == ["https://a/robots.txt", "https://a/x", "https://a/x"] and waits == [7.0]


def test_gives_up():
    client, asked, _ = made({"https://a/x": [Response(403)]})
    with pytest.raises(Failed) as e:
        client.get("https://a/x")
    assert e.value.status == 403 and asked.count("https://a/x") == 1
    client, asked, waits = made({"https://a/x": [Response(200, b"short", {"content-length": "99"})]}, retries=2)
    with pytest.raises(Failed, match="incomplete"):
        client.get("https://a/x")
    assert asked.count("https://a/x") == 3 and len(waits) == 2
    client, asked, _ = made({"https://a/x": [OSError("down"), Response(200, b"up")]})
    assert client.get("https://a/x").content == b"up"


def test_robots():
    rules = Response(200, b"User-agent: *\nCrawl-delay: 3\nDisallow: /Search\n")
    client, asked, waits = made({"https://a/robots.txt": [rules], "https://a/ok": [Response(200, b"")]})
    with pytest.raises(Refused):
        client.get("https://a/Search?p=1")
    assert asked == ["https://a/robots.txt"]
    client.get("https://a/ok")
    assert client.delay == 3 and waits == [3.0]
    client, asked, _ = made({"https://a/robots.txt": [Response(500)], "https://a/ok": [Response(200)]}, retries=0)
    with pytest.raises(Failed):
        client.get("https://a/ok")


def test_waits():
    now = datetime(2024, 1, 1, tzinfo=UTC)
    assert wait_seconds(0, "2", now, 0.5) == 2.0
    assert wait_seconds(0, "Mon, 01 Jan 2024 00:00:09 GMT", now, 0.5) == 9.0
    assert wait_seconds(0, "Sun, 31 Dec 2023 00:00:00 GMT", now, 0.5) == 0.0
    assert [wait_seconds(n, told, now, 0.5) for n, told in ((0, None), (3, "soon"), (9, "-1"))] == [1.5, 8.5, 20.5]


def test_capture(spark, tmp_path):
    from gneiss.sources import portal

    client, asked, _ = made({"https://a/1": [Response(200, "é".encode())], "https://a/2": [Response(404)]})
    rows = [{"url": "https://a/1", "group": "g", "type_id": "8", "year": 2020, "page": 1}, {"url": "https://a/2"}]
    assert capture(client, rows, str(tmp_path)) == {"captured": 1, "known": 0, "failed": 1}
    assert capture(client, rows, str(tmp_path)) == {"captured": 0, "known": 1, "failed": 1}
    portal.register(spark)
    got = spark.read.format("captured_pages").load(str(tmp_path)).collect()
    assert [(r.url, r.html, r.page) for r in got] == [("https://a/1", "é", 1)]
    assert sorted(p.suffix for p in tmp_path.iterdir()) == [".jsonl"]


def test_isolated_trials():
    data = b"abc" * 50_000
    asked = data, "gzip9", [len(data)], [hashlib.sha256(data).hexdigest()]
    here, there = (dict(zip(trials.FIELDS, f(*asked), strict=True)) for f in (trials.trial, trials.isolated))
    for name in ("status", "input_bytes", "payload_bytes", "output_bytes", "exact", "member_sha256", "error"):
        assert here[name] == there[name]
    assert there["status"] == "ok" and (there["peak_rss_bytes"] is None or there["peak_rss_bytes"] > 1 << 20)
    assert json.dumps(there)
    wrong = trials.isolated(data, "none", [0], [""])
    assert wrong[0] == "not_available"


def test_limits_of_trials(spark):
    slow = bytearray(hashlib.shake_256(b"x").digest(20_000_000))
    docs = spark.createDataFrame([("a", slow)], "sha string, content binary")
    late = codecs.benchmark_documents(docs, "sha", "content", ("lzma2",), seconds=0.5).first()
    assert (late.status, late.exact, late.output_bytes) == ("timeout", False, None)
    big = codecs.benchmark_documents(docs, "sha", "content", ("lzma2",), rss_bytes=30_000_000).first()
    assert big.status == "resource_limit" and big.peak_rss_bytes > 30_000_000
    good = codecs.benchmark_documents(docs, "sha", "content", ("zstd3",), seconds=60).first()
    assert good.status == "ok" and good.exact and good.input_bytes == len(slow)
