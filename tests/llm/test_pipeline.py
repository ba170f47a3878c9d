"""The pipeline's stages and its registered form."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F


def test_stages(spark, data):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{data}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_rules", "language_id", "ngram_jaccard", "pii", "packing"]
    held = docs.count()
    for name, stage in C.STAGES:
        out = C.materialize(stage(spark, docs, data), name)
        if name == "packing":
            assert out.select("doc_id").distinct().count() == held and {"sequence_id", "offset"} <= set(out.columns)
            break
        assert out.columns == docs.columns and out.count() <= held
        if name == "pii":
            assert out.count() == held and out.where(F.col("text").rlike("[a-z0-9]+@[a-z0-9]+[.]example")).count() == 0
        docs, held = out, out.count()
    assert 0 < held < 200


def test_run(spark, data):
    import corpus_pipeline as C

    got = C.run(spark, data)
    assert got.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


@pytest.mark.parametrize("name", ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_", "pipeline"])
def test_registered(name):
    import __spark_entry__ as E

    assert any(q.startswith(name) for q in E.queries())


def test_edge_rows(spark, tmp_path):
    """Nulls in every column, repeated rows and clashing names pass through all stages."""
    import corpus_pipeline as C

    text = " ".join(f"word{k}, other{k}." for k in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, text, "en", "s", 1), (4, text + " more words here.", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({"kept": F.lit(1), "score": F.lit("x"), "spans": F.lit(2), "fp": F.lit(3)})
    for name, stage in C.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, ""), name)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and len(docs.columns) == 9
    assert C.packing_stage(spark, docs, "").count() >= 1


def test_near_duplicates_keep_unique_rows(spark):
    """Only a row with a copy goes: not one without an id, nor one that shares an id with another text."""
    import corpus_pipeline as C

    text = lambda n: " ".join(f"w{n}x{k}" for k in range(40))
    rows = [(3, text(1)), (5, text(1)), (5, text(2)), (None, text(3)), (None, text(4)), (None, text(2)), (8, text(5)), (8, text(5)), (None, text(6)), (None, text(6)), (9, " "), (None, " "), (10, ""), (11, None), (12, None)]
    docs = spark.createDataFrame([(*r, k % 2) for k, r in enumerate(rows)], "doc_id long, text string, n long").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in C.near_duplicates(spark, docs, "").collect()), key=str)
    want = [(3, text(1)), (5, text(2)), (None, text(3)), (None, text(4)), (8, text(5)), (None, text(6)), (9, " "), (10, ""), (11, None), (12, None)]
    assert got == sorted(want, key=str)


def test_mixtures_stay(spark, data):
    """Documents of three or four known languages stay, whatever the largest share."""
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    names = sorted(r.lang for r in docs.select("lang").distinct().collect())
    part = {n: " ".join(r.text for r in docs.where(F.col("lang") == n).orderBy("doc_id").limit(5).collect())[:3000] for n in names}
    mixed = [(10**6 + k, " ".join(part[n] for n in names[k : k + 3]), None) for k in range(len(names) - 2)] + [(2 * 10**6, " ".join(part.values()), None), (3 * 10**6, "1 2 3", None)]
    docs = docs.unionByName(spark.createDataFrame(mixed, "doc_id long, text string, lang string"))
    model = C.langid.learn(docs.where(~C.langid.held_out(docs)).select("text", "lang"))
    found = {r.doc_id: r for r in C.langid.identify(docs.where("doc_id >= 1000000"), model).collect()}
    assert len(names) == 4 and all(found[m[0]].score < 0.5 and len(found[m[0]].shares) >= 3 for m in mixed[:-1])
    got = {r.doc_id for r in C.language_id(spark, docs, data).where("doc_id >= 1000000").collect()}
    assert got == {m[0] for m in mixed[:-1]}
