"""Areas in perimeters, the nearest perimeter, tables laid out by place and time."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.catalog.registry import query, table
from pricelab.operators.shapes import area_overlaps, nearest_perimeters
from pricelab.plans.staging import new_folder
from pricelab.sinks.layout import Box, Layout, read_box, write_layout


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.element_at("embedding", 1).cast("double").alias("x"),
        F.element_at("embedding", 2).cast("double").alias("y"),
    )


PLACES = "SELECT vec_id, embedding[1]::double AS x, embedding[2]::double AS y FROM embeddings"


def box_ring(x: str, y: str, half_x: str, half_y: str):
    corners = [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+")]
    vertices = ", ".join(
        f"struct({x} {a} ({half_x}) AS x, {y} {b} ({half_y}) AS y)" for a, b in corners
    )
    return F.expr(f"array({vertices})")


#: Per supplier a box around a centre of its own, alike in both engines.
CX, CY = "((s_suppkey * 37 % 101) / 160.0D - 0.3D)", "((s_suppkey * 53 % 97) / 150.0D - 0.32D)"
HALF_X, HALF_Y = "0.003D + (s_suppkey % 5) * 0.004D", "0.002D + (s_suppkey % 4) * 0.003D"

BOXES = """
    SELECT s_suppkey AS perimeter,
           (s_suppkey * 37 % 101) / 160.0::double - 0.3::double AS cx,
           (s_suppkey * 53 % 97) / 150.0::double - 0.32::double AS cy,
           0.003::double + (s_suppkey % 5) * 0.004::double AS hx,
           0.002::double + (s_suppkey % 4) * 0.003::double AS hy
    FROM supplier
"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("perimeter"), box_ring(CX, CY, HALF_X, HALF_Y).alias("ring")
    )


@query(
    f"""
    SELECT vec_id, perimeter, round(width * height / (0.03 * 0.02), 6) AS share FROM (
        SELECT vec_id, perimeter,
               least(x + 0.015, cx + hx) - greatest(x - 0.015, cx - hx) AS width,
               least(y + 0.01, cy + hy) - greatest(y - 0.01, cy - hy) AS height
        FROM ({PLACES}), ({BOXES}))
    WHERE width > 0 AND height > 0
    """
)
def perimeter_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of box areas around the places in each perimeter."""
    areas = places(spark, sf_dir).select("vec_id", box_ring("x", "y", "0.015D", "0.01D").alias("area_ring"))
    found = area_overlaps(areas, boxes(spark, sf_dir))
    return found.select("vec_id", "perimeter", F.round("share", 6).alias("share"))


@query(
    f"""
    SELECT vec_id, perimeter, round(d, 9) AS distance FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, perimeter) AS place FROM (
            SELECT vec_id, perimeter,
                   sqrt(pow(greatest(0, abs(x - cx) - hx), 2) + pow(greatest(0, abs(y - cy) - hy), 2)) AS d
            FROM ({PLACES}), ({BOXES})))
    WHERE place = 1 AND d <= 0.05
    """
)
def nearest_perimeter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nearest_perimeters(places(spark, sf_dir), boxes(spark, sf_dir), "vec_id", "perimeter", 0.05)
    return found.withColumn("distance", F.round("distance", 9))


@query(
    f"""
    SELECT vec_id, x, y, date FROM (
        SELECT *, DATE '2019-01-01' + (vec_id * 7 % 720)::integer AS date FROM ({PLACES}))
    WHERE x BETWEEN 0.0 AND 0.12 AND y BETWEEN -0.1 AND 0.05
        AND date BETWEEN DATE '2019-03-01' AND DATE '2019-10-31'
    """
)
def morton_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of the places, from a table laid out by place and day."""
    day = F.expr("date_add(DATE'2019-01-01', cast(vec_id * 7 % 720 AS int))")
    path = new_folder(spark, "layout")
    layout = Layout(
        "x", "y", "date", (-0.5, 0.5), (-0.5, 0.5), (date(2019, 1, 1), date(2020, 12, 21))
    )
    write_layout(places(spark, sf_dir).withColumn("date", day), layout, path)
    box = Box((0.0, 0.12), (-0.1, 0.05), (date(2019, 3, 1), date(2019, 10, 31)))
    return read_box(spark, path, layout, box)
