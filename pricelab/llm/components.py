"""Connected components of links between rows, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.plans.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(_a, _b) to one row per linked row: _row, _label, the least row of its component.

    Each step takes the least label among the neighbours, then the label of that label, so
    long chains halve; every step is written, and it ends when no label changes. A row with
    very many links is combined on the map side.
    """
    both = stage(
        edges.select("_a", "_b").union(edges.select("_b", "_a")).distinct(), "links"
    )
    labels = stage(
        both.groupBy("_a")
        .agg(F.min("_b").alias("_least"))
        .select(F.col("_a").alias("_row"), F.least("_a", "_least").alias("_label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("_row").alias("_b"), "_label"), "_b")
            .groupBy("_a")
            .agg(F.min("_label").alias("_near"))
            .select(F.col("_a").alias("_row"), "_near")
        )
        lowered = labels.join(near, "_row").select(
            "_row", F.col("_label").alias("_old"), F.least("_label", "_near").alias("_new")
        )
        jump = labels.select(F.col("_row").alias("_new"), F.col("_label").alias("_far"))
        lowered = stage(
            lowered.join(jump, "_new").select(
                "_row", F.least("_new", "_far").alias("_label"), "_old"
            ),
            "labels",
        )
        labels = lowered.select("_row", "_label")
        if lowered.where("_label < _old").isEmpty():
            return labels
