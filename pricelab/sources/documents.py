"""Nested provider documents: one JSON document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.functions import iso_date, to_amount
from pricelab.schemas import PROVIDER_DOCUMENT


def read_provider_series(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows (metric, zip_code, date, price), one per pair of each document.

    All metrics are read at once; the metric is taken from the file path, as in
    ``Z12345_MSPAH.json``. Pairs without a price keep their row.
    """
    documents = spark.read.schema(PROVIDER_DOCUMENT).json(paths)
    pairs = documents.select(
        F.regexp_extract("_metadata.file_path", r"_([A-Z]+)\.json", 1).alias("metric"),
        F.substring("dataset.dataset_code", 2, 5).alias("zip_code"),
        F.explode("dataset.data").alias("pair"),
    )
    return pairs.select(
        "metric",
        "zip_code",
        iso_date(F.try_element_at("pair", F.lit(1))).alias("date"),
        to_amount(F.try_element_at("pair", F.lit(2))).alias("price"),
    )
