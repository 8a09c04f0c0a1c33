"""What the category codes of a ledger stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def category_dictionary(
    df: DataFrame, code: Column, description: Column, limit: int | None = None
) -> DataFrame:
    """The distinct (building_code, description) pairs in order; ``limit`` rows at most."""
    pairs = df.select(code.alias("building_code"), description.alias("description")).distinct()
    ordered = pairs.orderBy("building_code", "description")
    return ordered if limit is None else ordered.limit(limit)


def description_lists(dictionary: DataFrame, most: int) -> DataFrame:
    """Per code its first ``most`` descriptions, and how many there are in all.

    Free text under one code may be without bound; a list is not.
    """
    by_code = Window.partitionBy("building_code").orderBy("description")
    placed = dictionary.withColumn("_place", F.row_number().over(by_code))
    first = F.when(F.col("_place") <= most, F.col("description"))
    return placed.groupBy("building_code").agg(
        F.array_sort(F.collect_list(first)).alias("descriptions"),
        F.count(F.lit(1)).alias("n_descriptions"),
    )
