"""Query functions and their SQL, by name."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.functions import month_start, unit_price, zip_from_int

Query = Callable[[SparkSession, str], DataFrame]

#: Seconds spent on writing the files that queries read.
fixture_seconds: list[float] = []

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        _queries[key] = function
        _oracles[key] = sql
        return function

    return register


@contextmanager
def fixture() -> Iterator[None]:
    """Around the writing of a query's input files, so that a benchmark can tell it apart."""
    start = time.perf_counter()
    yield
    fixture_seconds.append(time.perf_counter() - start)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as sales in the zip code of their customer's nation."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        zip_from_int(F.col("c_nationkey")).alias("zip_code"),
        month_start(F.col("o_orderdate")).alias("date"),
        F.col("o_totalprice").alias("price"),
        "c_mktsegment",
        "o_orderpriority",
    )


ORDER_SALES = """
    SELECT printf('%05d', c_nationkey) AS zip_code,
           date_trunc('month', o_orderdate)::date AS date,
           o_totalprice AS price, c_mktsegment, o_orderpriority
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


def part_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sales in the area of their part's brand."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("zip_code"),
        month_start(F.col("l_shipdate")).alias("date"),
        F.col("l_extendedprice").alias("price"),
        unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("price_sf"),
        "p_type",
    )


PART_SALES = """
    SELECT p_brand AS zip_code, date_trunc('month', l_shipdate)::date AS date,
           l_extendedprice AS price, l_extendedprice / nullif(l_quantity, 0) AS price_sf, p_type
    FROM lineitem JOIN part ON l_partkey = p_partkey
"""
