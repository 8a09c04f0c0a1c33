"""Row-wise operators: parsing, predicates, unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.catalog.medians import KNOWN_SALES, known_sales
from pricelab.catalog.registry import query, table
from pricelab.functions import (
    bracket_code,
    class_code,
    class_description,
    dotted_date,
    first_token,
    is_known_zip,
    month_start,
    yyyymm_date,
    zip_from_double,
    zip_from_int,
    zip_from_text,
)
from pricelab.operators.sales import is_housing, market_sales, unpivot_sales
from pricelab.operators.unify import as_series
from pricelab.operators.unify import union_sources as unite
from pricelab.plans.feeds import register_views


@query(
    """
    SELECT c_custkey, printf('%05d', c_nationkey) AS zip_int, printf('%05d', c_nationkey) AS zip_double,
           printf('%05d', c_nationkey) AS zip_text, c_nationkey > 0 AS known
    FROM customer
    """
)
def zip_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    zip_plus_four = F.concat(nation.cast("string"), F.lit("-1234"))
    short = F.lpad(nation.cast("string"), 5, "0")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        zip_from_int(nation).alias("zip_int"),
        zip_from_double(nation.cast("double")).alias("zip_double"),
        zip_from_text(zip_plus_four).alias("zip_text"),
        is_known_zip(short).alias("known"),
    )


@query(
    """
    SELECT o_orderkey, strptime(cast(year(o_orderdate) * 100 + month(o_orderdate) AS varchar), '%Y%m')::date AS date
    FROM orders
    """,
    name="yyyymm_date",
)
def yyyymm_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select("o_orderkey", yyyymm_date(number).alias("date"))


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate::date END AS date,
           date_trunc('month', o_orderdate)::date AS month
    FROM orders
    """,
    name="dotted_date",
)
def dotted_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    dotted = F.date_format("o_orderdate", "yyyy.MM.dd")
    written = F.when(F.col("o_orderstatus") == "F", "0000.00.00").otherwise(dotted)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        dotted_date(written).alias("date"),
        month_start(dotted_date(dotted)).alias("month"),
    )


@query(
    r"""
    SELECT p_partkey, split_part(p_name || ' (' || p_type || ')', ' ', 1) AS token,
           p_type AS code, '' AS no_code, substr(p_type, 1, 2) AS class, trim(substr(p_name, 3)) AS description
    FROM part
    """
)
def token_and_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.format_string("%s (%s)", "p_name", "p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        first_token(text).alias("token"),
        bracket_code(text).alias("code"),
        bracket_code(F.col("p_name")).alias("no_code"),
        class_code(F.col("p_type")).alias("class"),
        class_description(F.col("p_name")).alias("description"),
    )


HOUSING = """
    SELECT p_partkey,
           CASE p_type WHEN 'STANDARD' THEN 'STRY' WHEN 'ECONOMY' THEN 'HOUSING' WHEN 'PROMO' THEN 'OTHER'
                WHEN 'SMALL' THEN NULL ELSE 'OFFICE' END AS type1,
           CASE WHEN p_size < 10 THEN 'DWEL' WHEN p_size < 20 THEN 'HOUSING' WHEN p_size < 30 THEN 'STRY'
                WHEN p_size < 35 THEN 'OTHER' WHEN p_size < 40 THEN NULL ELSE 'SHOP' END AS type2
    FROM part
"""


@query(
    f"""
    SELECT * FROM ({HOUSING})
    WHERE type1 IN ('STRY', 'HOUSING', 'OTHER') AND type2 IN ('DWEL', 'HOUSING', 'STRY', 'OTHER')
    """
)
def housing_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, size = F.col("p_type"), F.col("p_size")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(kind == "STANDARD", "STRY")
        .when(kind == "ECONOMY", "HOUSING")
        .when(kind == "PROMO", "OTHER")
        .when(kind == "SMALL", F.lit(None))
        .otherwise("OFFICE")
        .alias("type1"),
        F.when(size < 10, "DWEL")
        .when(size < 20, "HOUSING")
        .when(size < 30, "STRY")
        .when(size < 35, "OTHER")
        .when(size < 40, F.lit(None))
        .otherwise("SHOP")
        .alias("type2"),
    )
    return parts.where(is_housing(F.col("type1"), F.col("type2")))


@query(
    """
    SELECT o_orderkey, o_orderdate::date AS date, o_totalprice AS price
    FROM orders WHERE o_totalprice >= 2000 AND o_orderstatus <> 'F'
    """
)
def price_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate").cast("date")).alias("date"),
        F.col("o_totalprice").alias("price"),
    )
    return market_sales(sales)


@query(
    """
    SELECT o_orderkey, date_trunc('month', date)::date AS date, price FROM (
        SELECT o_orderkey, o_orderdate::date AS date, o_totalprice AS price FROM orders
        UNION ALL
        SELECT o_orderkey, o_orderdate::date + 400, o_totalprice * 0.5 FROM orders
        UNION ALL
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate::date + 800 END, o_totalprice * 0.25
        FROM orders
    ) WHERE price >= 2000 AND date IS NOT NULL
    """
)
def wide_sales_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    pairs = [
        (month_start(sold), price),
        (month_start(F.date_add(sold, 400)), price * 0.5),
        (F.when(F.col("o_orderstatus") != "F", month_start(F.date_add(sold, 800))), price * 0.25),
    ]
    return market_sales(unpivot_sales(table(spark, sf_dir, "orders"), pairs, ["o_orderkey"]))


@query(
    f"""
    SELECT zip_code, date, price FROM (
        SELECT zip_code, date, price FROM ({KNOWN_SALES})
        WHERE substr(o_orderpriority, 1, 1) IN ('1', '3', '5'))
    """
)
def view_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment's sales by SQL text over a registered view."""
    register_views({"pricelab_known_sales": known_sales(spark, sf_dir)})
    return spark.sql(
        """
        SELECT zip_code, date, price FROM (
            SELECT zip_code, date, price FROM pricelab_known_sales
            WHERE substring(o_orderpriority, 1, 1) IN ('1', '3', '5'))
        """
    )


@query(
    """
    SELECT 'NYC' AS source, 'allHomes' AS segment, 'price' AS measure, printf('%05d', o_custkey) AS zip_code,
           date_trunc('month', o_orderdate)::date AS date, o_totalprice AS price FROM orders
    UNION ALL
    SELECT 'RDC', 'allHomes', 'price_sf', printf('%05d', l_suppkey), date_trunc('month', l_shipdate)::date,
           l_extendedprice / nullif(l_quantity, 0) FROM lineitem
    UNION ALL
    SELECT 'QZ', 'condos', 'price_sf', printf('%05d', user_id), date_trunc('month', ts)::date, value FROM events
    """
)
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = table(spark, sf_dir, "orders").select(
        zip_from_int(F.col("o_custkey")).alias("zip_code"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("price"),
    )
    listing = table(spark, sf_dir, "lineitem").select(
        zip_from_int(F.col("l_suppkey")).alias("zip_code"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
    )
    provider = table(spark, sf_dir, "events").select(
        zip_from_int(F.col("user_id")).alias("zip_code"),
        F.col("ts").cast("date").alias("date"),
        F.col("value").alias("price"),
    )
    return unite(
        [
            as_series(ledger, source="NYC", segment="allHomes", measure="price"),
            as_series(listing, source="RDC", segment="allHomes", measure="price_sf"),
            as_series(provider, source="QZ", segment="condos", measure="price_sf"),
        ]
    )
