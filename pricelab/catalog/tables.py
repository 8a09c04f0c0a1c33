"""Series written to tables and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.catalog.medians import (
    AREA_MONTH,
    KNOWN_SALES,
    SEGMENT_MEDIANS,
    known_sales,
    type_segments,
)
from pricelab.catalog.registry import part_sales, query
from pricelab.fixed_values import LEDGER
from pricelab.operators.medians import Measure, exact_medians
from pricelab.operators.segments import segment_medians
from pricelab.operators.unify import as_series
from pricelab.plans.feeds import source_tables, write_series
from pricelab.plans.staging import new_folder
from pricelab.sinks.tables import FolderTarget


@query(
    f"""
    SELECT segment || CASE measure WHEN 'price' THEN '' ELSE 'BySF' END || 'NYC' AS table_name,
           zip_code, date, price
    FROM ({SEGMENT_MEDIANS})
    """
)
def series_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aggregate, six tables."""
    sales = part_sales(spark, sf_dir)
    medians = segment_medians(sales, type_segments(F.col("p_type")), staged=True)
    target = FolderTarget(new_folder(spark, "tables"))
    write_series(as_series(medians, source=LEDGER), LEDGER, target)
    written = [
        target.read(spark, name).select(F.lit(name).alias("table_name"), *AREA_MONTH, "price")
        for name in source_tables(LEDGER)
    ]
    return reduce(DataFrame.unionByName, written)


@query(
    f"""
    WITH medians AS (
        SELECT zip_code, date, quantile_disc(price, 0.5) AS price
        FROM ({KNOWN_SALES}) GROUP BY zip_code, date)
    SELECT * FROM medians UNION ALL SELECT * FROM medians
    """
)
def sink_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created, appended to, left alone by ``ignore``, and read back."""
    sales = known_sales(spark, sf_dir).select(*AREA_MONTH, "price")
    medians = exact_medians(sales, AREA_MONTH, [Measure("price", F.col("price"))], staged=True)
    target = FolderTarget(new_folder(spark, "tables"))
    target.write(medians, "allHomes")
    once = target.read(spark, "allHomes")
    target.write(once, "copy", "overwrite")
    target.write(once, "copy", "append")
    target.write(once, "copy", "ignore")
    return target.read(spark, "copy")
