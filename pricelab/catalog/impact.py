"""Events and perimeters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.catalog.medians import AREA_MONTH
from pricelab.catalog.registry import ORDER_SALES, order_sales, query, table
from pricelab.functions import zip_from_int
from pricelab.operators import impact
from pricelab.operators.medians import Measure, exact_medians
from pricelab.operators.perimeters import points_in_perimeters
from pricelab.plans.staging import stage


def nation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation an event in the middle of a month, and again with another id some days on.

    One more area has an event and no sales.
    """
    start = F.lit("1996-01-11").cast("date")
    nations = table(spark, sf_dir, "nation").select(
        zip_from_int(F.col("n_nationkey")).alias("zip_code"),
        F.add_months(start, F.col("n_nationkey")).alias("event_month"),
    )
    again = nations.withColumn("event_month", F.date_add("event_month", 9))
    nowhere = nations.where("zip_code = '00000'").withColumn("zip_code", F.lit("99999"))
    return nations.withColumn("id", F.lit(1)).unionByName(again.withColumn("id", F.lit(2))).unionByName(
        nowhere.withColumn("id", F.lit(3))
    )


EVENTS = """
    SELECT printf('%05d', n_nationkey) AS zip_code,
           (DATE '1996-01-01' + to_months(n_nationkey))::date AS event_month
    FROM nation
    UNION SELECT '99999', DATE '1996-01-01'
"""


@query(
    f"""
    WITH near AS (
        SELECT zip_code, event_month, date, price
        FROM ({ORDER_SALES}) JOIN ({EVENTS}) USING (zip_code)
        WHERE date >= event_month - INTERVAL 6 MONTH AND date < event_month + INTERVAL 6 MONTH),
    medians AS (
        SELECT zip_code, event_month,
               quantile_disc(price, 0.5) FILTER (WHERE date < event_month) AS price_before,
               quantile_disc(price, 0.5) FILTER (WHERE date >= event_month) AS price_after
        FROM near GROUP BY zip_code, event_month)
    SELECT zip_code, event_month, price_before, price_after,
           (price_after - price_before) / price_before AS change
    FROM ({EVENTS}) LEFT JOIN medians USING (zip_code, event_month)
    """
)
def event_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = order_sales(spark, sf_dir).select(*AREA_MONTH, "price")
    return impact.event_impact(sales, nation_events(spark, sf_dir), months=6, staged=True)


@query(
    f"""
    WITH sales AS ({ORDER_SALES}), events AS ({EVENTS}),
    baseline AS (
        SELECT zip_code, event_month, quantile_disc(price, 0.5) AS baseline
        FROM sales JOIN events USING (zip_code)
        WHERE date >= event_month - INTERVAL 6 MONTH AND date < event_month
        GROUP BY zip_code, event_month),
    monthly AS (SELECT zip_code, date, quantile_disc(price, 0.5) AS price FROM sales GROUP BY zip_code, date),
    later AS (
        SELECT zip_code, event_month, min(date) AS recovered
        FROM baseline JOIN monthly USING (zip_code)
        WHERE date > event_month AND price >= baseline
        GROUP BY zip_code, event_month)
    SELECT zip_code, event_month, baseline, recovered,
           cast(datediff('month', event_month, recovered) AS integer) AS n_months
    FROM events LEFT JOIN baseline USING (zip_code, event_month)
         LEFT JOIN later USING (zip_code, event_month)
    """
)
def recovery_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = stage(order_sales(spark, sf_dir).select(*AREA_MONTH, "price"), "sales")
    monthly = exact_medians(sales, AREA_MONTH, [Measure("price", F.col("price"))])
    return impact.recovery_months(sales, monthly, nation_events(spark, sf_dir), 6)


def perimeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region, a square and a diamond around a centre of its own."""
    regions = table(spark, sf_dir, "region").withColumn("c", F.col("r_regionkey") / 20.0 - 0.1)
    c = F.col("c")

    def ring(*offsets: tuple[float, float]):
        return F.array(*[F.struct((c + x).alias("x"), (c + y).alias("y")) for x, y in offsets])

    square = ring((-0.1, -0.1), (0.1, -0.1), (0.1, 0.1), (-0.1, 0.1))
    diamond = ring((0.0, -0.02), (0.02, 0.0), (0.0, 0.02), (-0.02, 0.0))
    shapes = F.array(
        F.struct(F.lit("square").alias("shape"), square.alias("ring")),
        F.struct(F.lit("diamond").alias("shape"), diamond.alias("ring")),
    )
    return regions.select(F.col("r_regionkey").alias("region"), F.inline(shapes))


POINTS = "SELECT vec_id, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings"


@query(
    f"""
    SELECT vec_id, x, y, r_regionkey AS region, shape
    FROM ({POINTS}), (SELECT r_regionkey, r_regionkey / 20.0 - 0.1 AS c FROM region),
         (VALUES ('square'), ('diamond')) shapes(shape)
    WHERE CASE shape WHEN 'square' THEN greatest(abs(x - c), abs(y - c)) < 0.1
               ELSE abs(x - c) + abs(y - c) < 0.02 END
    """
)
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.element_at("embedding", 1).cast("double").alias("x"),
        F.element_at("embedding", 2).cast("double").alias("y"),
    )
    return points_in_perimeters(points, perimeters(spark, sf_dir))
