"""Medians per area and month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.catalog.registry import (
    ORDER_SALES,
    PART_SALES,
    order_sales,
    part_sales,
    query,
    table,
)
from pricelab.fixed_values import ALL_HOMES, CONDOS, PER_SQUARE_FOOT, SINGLE_FAMILY, TOTAL
from pricelab.functions import class_code, class_description, is_known_zip
from pricelab.operators.dictionary import category_dictionary as dictionary
from pricelab.operators.medians import Measure, approx_medians, exact_medians, small_side
from pricelab.operators.sales import market_sales
from pricelab.operators.segments import appended_medians, repeated_keys
from pricelab.operators.segments import segment_medians as medians_by_segment
from pricelab.plans.staging import stage

AREA_MONTH = ["zip_code", "date"]


def known_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = market_sales(order_sales(spark, sf_dir))
    return sales.where(is_known_zip(F.col("zip_code")))


KNOWN_SALES = f"SELECT * FROM ({ORDER_SALES}) WHERE price >= 2000 AND zip_code > '00000'"


@query(
    f"""
    SELECT zip_code, date, quantile_disc(price, 0.5) AS price
    FROM ({KNOWN_SALES}) GROUP BY zip_code, date
    """
)
def median_area_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = known_sales(spark, sf_dir).select(*AREA_MONTH, "price")
    medians = exact_medians(sales, AREA_MONTH, [Measure("price", F.col("price"))], staged=True)
    return medians.where(F.col("price").isNotNull())


@query(
    f"""
    SELECT zip_code, date, count(*) AS n_sales, TRUE AS within_bound
    FROM ({KNOWN_SALES}) GROUP BY zip_code, date
    """
)
def approx_median_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate medians, held against the ranks they may have.

    The values depend on the order in which sketches meet, so what is returned
    is whether each lies within one percent of the ranks of its group.
    """
    sales = stage(known_sales(spark, sf_dir).select(*AREA_MONTH, "price"), "sales")
    medians = approx_medians(sales, AREA_MONTH, [Measure("median", F.col("price"))], accuracy=100)
    medians = stage(medians, "medians")
    ranked = (
        sales.join(small_side(medians, medians.count()), AREA_MONTH)
        .groupBy(*AREA_MONTH)
        .agg(
            F.count(F.lit(1)).alias("n_sales"),
            F.count_if(F.col("price") < F.col("median")).alias("below"),
            F.count_if(F.col("price") <= F.col("median")).alias("up_to"),
        )
    )
    return ranked.select(*AREA_MONTH, "n_sales", rank_is_near().alias("within_bound"))


def rank_is_near() -> Column:
    """Whether a value with so many ``below`` and ``up_to`` it is within a percent of the middle."""
    middle = F.ceil(F.col("n_sales") / 2)
    slack = F.ceil(F.col("n_sales") / 100)
    return (F.col("below") - slack < middle) & (middle <= F.col("up_to") + slack)


@query(
    f"""
    SELECT zip_code, date, quantile_disc(price_sf, 0.5) AS price
    FROM ({PART_SALES}) GROUP BY zip_code, date HAVING quantile_disc(price_sf, 0.5) IS NOT NULL
    """
)
def unit_price_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = part_sales(spark, sf_dir).select(*AREA_MONTH, "price_sf")
    medians = exact_medians(sales, AREA_MONTH, [Measure("price", F.col("price_sf"))], staged=True)
    return medians.where(F.col("price").isNotNull())


def type_segments(category: Column) -> dict[str, Column]:
    return {
        ALL_HOMES: category.isin("STANDARD", "ECONOMY", "MEDIUM", "PROMO", "SMALL"),
        CONDOS: category.isin("PROMO", "SMALL"),
        SINGLE_FAMILY: category == "STANDARD",
    }


SEGMENT_SETS = {
    ALL_HOMES: "'STANDARD', 'ECONOMY', 'MEDIUM', 'PROMO', 'SMALL'",
    CONDOS: "'PROMO', 'SMALL'",
    SINGLE_FAMILY: "'STANDARD'",
}

SEGMENT_VALUES = " UNION ALL ".join(
    f"""SELECT zip_code, date, '{segment}' AS segment, '{measure}' AS measure, {measure} AS value
        FROM sales WHERE p_type IN ({types})"""
    for segment, types in SEGMENT_SETS.items()
    for measure in (TOTAL, PER_SQUARE_FOOT)
)

SEGMENT_MEDIANS = " UNION ALL ".join(
    f"""
    SELECT zip_code, date, '{segment}' AS segment, '{measure}' AS measure,
           quantile_disc({measure}, 0.5) AS price
    FROM ({PART_SALES}) WHERE p_type IN ({types})
    GROUP BY zip_code, date HAVING quantile_disc({measure}, 0.5) IS NOT NULL
    """
    for segment, types in SEGMENT_SETS.items()
    for measure in (TOTAL, PER_SQUARE_FOOT)
)


@query(SEGMENT_MEDIANS)
def segment_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = part_sales(spark, sf_dir)
    return medians_by_segment(sales, type_segments(F.col("p_type")), staged=True)


@query(
    f"""
    WITH sales AS ({PART_SALES}), long AS ({SEGMENT_VALUES})
    SELECT zip_code, date, segment, measure, count(*) AS n_sales, TRUE AS within_bound
    FROM long WHERE value IS NOT NULL GROUP BY ALL
    """
)
def approx_segment_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate medians of all segments and measures, held against their ranks."""
    sales = stage(part_sales(spark, sf_dir), "sales")
    segments = type_segments(F.col("p_type"))
    keys = [*AREA_MONTH, "segment", "measure"]
    medians = stage(medians_by_segment(sales, segments, method="approx", accuracy=100), "medians")
    values = sales.select(
        *AREA_MONTH,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(segment).alias("segment"),
                        F.lit(measure).alias("measure"),
                        F.when(where, F.col(measure)).alias("value"),
                    )
                    for segment, where in segments.items()
                    for measure in (TOTAL, PER_SQUARE_FOOT)
                ]
            )
        ),
    ).where(F.col("value").isNotNull())
    ranked = (
        values.join(small_side(medians, medians.count()), keys)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_sales"),
            F.count_if(F.col("value") < F.col("price")).alias("below"),
            F.count_if(F.col("value") <= F.col("price")).alias("up_to"),
        )
    )
    return ranked.select(*keys, "n_sales", rank_is_near().alias("within_bound"))


def skewed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most sales are of one area, and their prices have a long tail."""
    hot = F.col("o_orderkey") % 10 < 7
    return table(spark, sf_dir, "orders").select(
        F.when(hot, "99999").otherwise(F.col("o_orderpriority")).alias("zip_code"),
        F.when(hot, F.exp(F.col("o_totalprice") / 2000)).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(~hot | (F.col("o_orderkey") % 3 == 0), F.col("o_custkey")).alias("customer"),
    )


SKEWED_MEDIANS = """
    WITH sales AS (
        SELECT CASE WHEN o_orderkey % 10 < 7 THEN '99999' ELSE o_orderpriority END AS zip_code,
               o_totalprice AS total, o_orderkey % 10 < 7 AS hot,
               CASE WHEN o_orderkey % 10 >= 7 OR o_orderkey % 3 = 0 THEN o_custkey END AS customer
        FROM orders)
    SELECT zip_code, count(*) AS n_sales,
           CASE WHEN any_value(hot) THEN exp(quantile_disc(total, 0.5) / 2000)
                ELSE quantile_disc(total, 0.5) END AS price,
           quantile_disc(customer, 0.5) AS customer
    FROM sales GROUP BY zip_code
"""


def skewed(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    sales = stage(skewed_sales(spark, sf_dir), "sales")
    measures = [Measure(name, F.col(name)) for name in ("price", "customer")]
    sizes = sales.groupBy("zip_code").agg(F.count(F.lit(1)).alias("n_sales"))
    return exact_medians(sales, ["zip_code"], measures, **limits).join(sizes, "zip_code")


@query(SKEWED_MEDIANS)
def skewed_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group is hot; the hot keys are broadcast."""
    return skewed(spark, sf_dir, hot_rows=1_000)


@query(SKEWED_MEDIANS)
def skewed_medians_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where no side may be broadcast."""
    return skewed(spark, sf_dir, hot_rows=1_000, broadcast_rows=0)


@query(
    """
    SELECT DISTINCT substr(o_orderpriority, 1, 2) AS building_code,
           trim(substr(o_orderpriority, 3)) AS description
    FROM orders
    """
)
def category_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return dictionary(table(spark, sf_dir, "orders"), class_code(priority), class_description(priority))


@query(
    f"""
    WITH sales AS ({KNOWN_SALES}),
    appended AS (
        SELECT zip_code, date, quantile_disc(price, 0.5) AS price
        FROM sales GROUP BY c_mktsegment, zip_code, date),
    whole AS (
        SELECT zip_code, date, quantile_disc(price, 0.5) AS global_price
        FROM sales GROUP BY zip_code, date)
    SELECT zip_code, date, count(*) AS n_rows, min(price) AS min_price, max(price) AS max_price,
           any_value(global_price) AS global_price
    FROM appended JOIN whole USING (zip_code, date)
    GROUP BY zip_code, date HAVING count(*) > 1
    """
)
def area_append_vs_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas that get several rows a month if each region is appended on its own."""
    sales = stage(known_sales(spark, sf_dir).select("c_mktsegment", *AREA_MONTH, "price"), "sales")
    repeated = repeated_keys(appended_medians(sales, "c_mktsegment"))
    whole = exact_medians(sales, AREA_MONTH, [Measure("global_price", F.col("price"))])
    return repeated.join(whole, AREA_MONTH)


@query(
    f"""
    WITH sales AS ({KNOWN_SALES})
    SELECT 'area' AS grain, zip_code, date, quantile_disc(price, 0.5) AS price
    FROM sales GROUP BY zip_code, date
    UNION ALL
    SELECT c_mktsegment, zip_code, date, quantile_disc(price, 0.5)
    FROM sales GROUP BY c_mktsegment, zip_code, date
    """
)
def checkpoint_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two medians from sales prepared once and written to shared storage."""
    sales = stage(known_sales(spark, sf_dir).select("c_mktsegment", *AREA_MONTH, "price"), "sales")
    price = [Measure("price", F.col("price"))]
    by_area = exact_medians(sales, AREA_MONTH, price).withColumn("grain", F.lit("area"))
    by_region = exact_medians(sales, ["c_mktsegment", *AREA_MONTH], price)
    return by_area.unionByName(by_region.withColumnRenamed("c_mktsegment", "grain"))
