"""One data model over all sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.functions import month_start
from pricelab.schemas import UNIFIED_SERIES


def as_series(df: DataFrame, **labels: str) -> DataFrame:
    """The unified record; ``labels`` fill source, segment or measure."""
    return df.select(
        *[
            (F.lit(labels[f.name]) if f.name in labels else F.col(f.name))
            .cast(f.dataType)
            .alias(f.name)
            for f in UNIFIED_SERIES.fields
        ]
    )


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All series in one frame, every date moved to the first of its month."""
    united = reduce(DataFrame.unionByName, frames)
    return united.withColumn("date", month_start(F.col("date")))
