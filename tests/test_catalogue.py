"""Every query against its SQL twin on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from gneiss.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "tzinfo") else v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    key = lambda r: tuple((x is None, str(type(x)), x) for x in r)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    wanted = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall()), key=key)
    assert rows == wanted


def test_no_python_in_sql_queries(spark, data):
    """Plans of relational queries hold no Python node."""
    for name in ("content_redundancy", "size_distribution", "status_counts", "membership_distribution", "first_wins"):
        plan = QUERIES[name](spark, data)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_all_codecs(spark, data):
    """Every codec of the operator takes every document and gives it back."""
    from gneiss.operators import codecs

    n = spark.read.parquet(f"{data}/documents.parquet").count()
    got = {r.method: (r.status, r.exact, r.n) for r in QUERIES["codec_roundtrip"](spark, data).collect()}
    assert got == {m: ("ok", True, n) for m in codecs.METHODS}


def against_sql(spark, folder, name, table, rows):
    """The query and its SQL over one table of the given rows."""
    rows.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    df = QUERIES[name](spark, str(folder))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    wanted = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    return sorted(tuple(r) for r in df.collect()), sorted(wanted)


def test_font_names_of_large_keys(spark, tmp_path):
    """Sizes stay in KiB beyond 1024 KiB, as in the SQL."""
    keys = [1021, 1023, 1025, 1048575, 1048576, 1048591, 1199999, 1 << 30, (1 << 40) + 1, (1 << 50) + 128]
    rows = spark.createDataFrame([(k, "blue anvil") for k in keys], "p_partkey bigint, p_name string")
    got, wanted = against_sql(spark, tmp_path, "font_names", "part", rows)
    assert got == wanted and {len(r) for r in got} == {4}


def test_reference_pages_of_equal_keys(spark, tmp_path):
    """A page whose key is the number that it links keeps its reference."""
    rows = spark.createDataFrame([(1108014, 108014), (1000007, 7), (1000000, 0), (5, 5), (0, 1), (1000008, 7)], "o_orderkey bigint, o_custkey bigint")
    got, wanted = against_sql(spark, tmp_path, "reference_pages", "orders", rows)
    assert got == wanted and len(got) == 6
