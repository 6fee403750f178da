"""A training-data pipeline over documents: each stage's result is written, and read by the next.

It needs skein.llm and goes with it. Columns besides doc_id and text pass through all stages but the last,
whatever their names. An empty table gives an empty result. What each stage does with rows without a doc_id,
without a text, or that repeat a doc_id stands with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skein.llm.common import saved
from skein.llm.line_dedup import dedup_lines
from skein.llm.minhash_dedup import near_duplicates
from skein.llm.packing import packed, tokenized
from skein.llm.queries import table, tokenizer_path
from skein.llm.secret_scan import redact
from skein.llm.toxicity import default_categories, score, train


def sized(docs: DataFrame, text: DataFrame) -> DataFrame:
    """text with the columns of docs, n_chars counted anew where there is one."""
    if "n_chars" in docs.columns:
        text = text.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return text.select(docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go. Every row is judged by its text; null and empty texts stay."""
    chain = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), default_categories())
    return score(docs, chain).where(~F.col("rejected")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 or more characters in 5 or more documents stay in one of them.

    Rows that share a doc_id are one document, those without one too (the one that gives way to all others). Null texts stay null.
    """
    return sized(docs, dedup_lines(docs))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays, that with the smallest doc_id.

    Each row is linked for itself, so rows that repeat a doc_id go only as copies of another row; rows without one stay,
    and so do null and blank texts, which are nobody's copies.
    """
    rows = saved(docs.withColumn("__skein_row", F.monotonically_increasing_id()), "rows")
    named = rows.where("doc_id is not null")
    own = named.select(F.col("__skein_row").alias("doc_id"), "text")
    groups = saved(near_duplicates(own, shingle=5, percent=80).select(F.col("doc_id").alias("__skein_row"), "component_id"), "groups")
    kept = groups.join(named.select("__skein_row", "doc_id"), "__skein_row").groupBy("component_id").agg(F.min_by("__skein_row", F.struct("doc_id", "__skein_row")).alias("__skein_row"))
    return named.join(kept, "__skein_row", "left_semi").unionByName(rows.where("doc_id is null")).select(docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; every row stays, null texts as they are."""
    return sized(docs, redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces (ids as little-endian uint32) with their places in sequences of 2048 tokens.

    Every row has pieces of its own; a null or empty text has one, the closing id.
    """
    pieces = tokenized(docs, tokenizer_path("word_bpe_49k.json"))
    # doc_id and piece need not be unique; the number stays as it is once written
    pieces = saved(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    places = packed(pieces.select("row", "doc_id", "piece", "start", "length"))
    return places.join(pieces.select("row", "ids"), "row").select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL expresses neither the trained classifier nor the packing.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
