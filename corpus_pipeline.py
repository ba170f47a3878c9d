"""The corpus pipeline: five stages over documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm import jaccard, langid, packing, pii, quality
from gneiss.llm.storage import materialize, shielded

#: Documents whose language, or set of languages, is less sure than this go.
LEAST_SCORE = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that fail a rule go; documents that fail the base rules or lose too much text go."""
    return quality.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no sure set of languages, go; lang becomes the language of the largest share."""
    model = langid.learn(docs.where(~langid.held_out(docs)).select("text", "lang"))

    def work(own: DataFrame) -> DataFrame:
        found = langid.identify(own, model)
        # the score is the top language's share of a mixture times the certainty of the chosen languages
        sure = F.col("score") / F.try_element_at("shares", F.col("lang_pred"))
        return found.where((F.col("lang_pred") != "und") & (sure >= LEAST_SCORE)).withColumn("lang", F.col("lang_pred"))

    return shielded(docs, ("doc_id", "text", "lang"), work)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates stays: that of the least id, of rows without an id the last choice.

    Rows are told apart by two hashes of all columns, not by doc_id; rows equal in every column are one.  Of
    rows without a word one for each text stays, and all whose text is null.
    """
    parts = [x for f in docs.schema.fields if "map<" not in f.dataType.simpleString() for x in (F.col(f"`{f.name}`").isNull(), F.col(f"`{f.name}`"))]
    keyed = docs.withColumns({"__key": F.xxhash64(*parts), "__check": F.xxhash64(F.lit(1), *parts)})
    found = jaccard.near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text")).select(F.col("doc_id").alias("__key"), F.col("component_id").alias("__component"))
    blank = F.when(~F.col("text").rlike(r"[^ \t-\r]"), F.col("text"))
    named = keyed.select("__key", "doc_id", blank.alias("__blank")).join(found.distinct(), "__key")
    group = F.when(F.col("__blank").isNull(), F.col("__component"))
    keep = named.groupBy("__blank", group.alias("__group")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__key")).alias("least"))
    return keyed.join(keep.select(F.col("least.__key").alias("__key")), "__key", "left_semi").dropDuplicates(["__key", "__check"]).drop("__key", "__check")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data give way to their kinds in angle brackets."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("pii", personal_data),
    ("packing", packing_stage),
]

#: SQL can't express the learned stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
