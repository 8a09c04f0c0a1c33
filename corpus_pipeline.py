"""From raw documents to packed training sequences.

Quality filter, line deduplication, one document per group of near copies, sources mixed to
target weights, best-fit packing. Each stage works on all that its predecessor kept, and
its result is written and read again before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.llm import dart_minhash, line_dedup, mixing, packing, quality
from pricelab.llm.inputs import read
from pricelab.plans.staging import new_folder, staging_scope

#: The columns of documents, in order; ``OTHERS`` only pass through.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
OTHERS = ["lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality ranking accepts."""
    model = quality.fit_on_labels(docs, read(spark, sf_dir, "labels"))
    scored = quality.quality_scores(docs, model, keep=OTHERS)
    return scored.where("predicted = 1").select(COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that occur earlier; documents of which none is left go."""
    found = line_dedup.deduplicated_lines(docs, keep=OTHERS)
    left = (F.col("n_dropped") == 0) | (F.trim("text", F.lit(" \n\t\r")) != "")
    return found.where(left).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return dart_minhash.without_near_copies(docs, keep=OTHERS).select(COLUMNS)


def with_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with the learned quality score; scored in each pass, so that no text is written again."""
    model = quality.fit_on_labels(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model, keep=OTHERS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, by their quality."""
    scored = with_quality(spark, docs, sf_dir)
    return mixing.mixed_documents(scored, weight=mixing.score_weight("score")).select(COLUMNS)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per piece: doc_id, copy, piece, start, length, ids_crc32, sequence_id, offset, ids."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("line_deduplication", line_deduplication),
    ("near_deduplication", near_deduplication),
    ("source_mixing", source_mixing),
    ("sequence_packing", sequence_packing),
]

#: Signatures, fitted weights and tokenizers have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage needs only meanwhile is deleted."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        written = new_folder(spark, name)
        with staging_scope(spark):
            result = function(spark, docs, sf_dir)
            result.write.parquet(written)
        docs = spark.read.schema(result.schema).parquet(written)
    return docs
