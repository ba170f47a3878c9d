"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gneiss.llm import bpe, flac, html, jaccard, langid, packing, pii, quality, toxicity, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 1024 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op2_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a FLAC stream and back: digests and features of what was read."""
    return flac.round_trip(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: five-word shingles, similarity 0.75."""
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(_table(spark, sf_dir, "pages"))


def op5_url_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    return langid.identify_documents(_table(spark, sf_dir, "documents"))


def op7_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, symbol and repetition counts of every document and whether it stays."""
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of base spans, and all spans, of every document."""
    found = pii.find_spans(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"CAST(size(filter(base_spans, x -> x.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base_spans"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op9_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labelled ones that aren't held out."""
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_flac_media,
        op3_ngram_jaccard,
        op4_tag_path_text,
        op5_url_boosting,
        op6_language_mixture,
        op7_line_cleaning,
        op8_weak_pii,
        op9_toxic_grammar,
        op10_byte_bpe,
    )
}
ORACLES: dict[str, str] = {"op7_line_cleaning": quality.ORACLE}
