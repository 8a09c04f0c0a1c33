"""Exact duplicates by content sort.

Normalised texts are range-partitioned on splitters that Spark samples, an external
sort puts equal ones side by side, and each is compared in full with its neighbour.
Splitters pass through the driver, so they are the first bytes of a text and two hashes of
all of it, which bounds them however long texts are; equal texts have equal ones.

A group of copies may hold a third of all rows, so copies are first counted per text
and salt, combined on the map side: at most ``salts`` rows of a group reach the sort.
Each document then finds its group by the digest of its text, in a join whose large
partitions adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.inputs import whole_text

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SALTS = 32

#: Characters of a text that splitters hold.
SPLITTER_CHARS = 32


def normalised(text: str | Column) -> Column:
    """The text with A-Z in lower case and all else as it is; empty where NULL."""
    text = whole_text(text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def text_groups(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """(_id, _norm) to one row per different text: _norm, _keep, _size."""
    counted = rows.groupBy("_norm", F.pmod(F.xxhash64("_id"), F.lit(salts)).alias("_salt")).agg(
        F.max("_id").alias("_keep"), F.count("*").alias("_n")
    )
    splitter = {
        "_front": F.left("_norm", F.lit(SPLITTER_CHARS)),
        "_h1": F.xxhash64("_norm"),
        "_h2": F.xxhash64(F.lit("again"), "_norm"),
    }
    # Within a partition by splitter, then in full; partitioning by all of them needs no
    # further shuffle, as equal texts have equal splitters.
    text = [*splitter, "_norm"]
    last_first = F.col("_keep").desc_nulls_last()
    return (
        counted.withColumns(splitter)
        .repartitionByRange(*splitter)
        .sortWithinPartitions(*text, last_first)
        .select(
            "_norm",
            "_keep",
            F.row_number().over(Window.partitionBy(*text).orderBy(last_first)).alias("_place"),
            F.sum("_n").over(Window.partitionBy(*text)).alias("_size"),
        )
        .where("_place = 1")
        .drop("_place")
    )


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", salts: int = SALTS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    * NULL and empty texts are equal to each other.
    * A NULL id is smaller than any other; a group of NULL ids has keep_id NULL.
    * Of rows that repeat the kept id and text exactly one has ``kept``.
    * Other columns are not read, whatever their names; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_column).alias("_id"), normalised(F.col(text_column)).alias("_norm")
    )
    groups = text_groups(rows, salts).select(
        F.sha2("_norm", 256).alias("_sha"), F.col("_keep"), F.col("_size")
    )
    found = rows.select("_id", F.sha2("_norm", 256).alias("_sha")).join(groups, "_sha")
    repeated = found.groupBy("_sha", "_id", "_keep", "_size").agg(F.count("*").alias("_times"))
    return repeated.select(
        F.col("_id").alias("doc_id"),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_sha").alias("text_sha256"),
        F.expr("_id <=> _keep").alias("_is_kept"),
        F.explode(F.expr("sequence(1L, _times)")).alias("_time"),
    ).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("_is_kept") & (F.col("_time") == 1)).alias("kept"),
        "text_sha256",
    )
