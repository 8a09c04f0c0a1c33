"""Feeds read from files. The files are written by Spark from the given tables first."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab import fixed_values as V
from pricelab.catalog import book_writer
from pricelab.catalog.registry import fixture, query, table
from pricelab.plans import feeds
from pricelab.plans.staging import new_folder, stage
from pricelab.sources.delimited import header, read_csv
from pricelab.sources.documents import read_provider_series
from pricelab.sources.sheets import infer_schema, read_sheets


def write_csv(df: DataFrame, label: str) -> str:
    path = new_folder(df.sparkSession, label)
    with fixture():
        df.write.option("header", True).csv(path)
    return path


# ---- CSV ---------------------------------------------------------------------

ODD_DATE = "SALE SEGMENT 1: Date (YYYY.MM.DD) (FIELD #89)"
ODD_PRICE = "SALE SEGMENT 1: Price/Total (C.A.M.A. #90)"


@query(
    """
    SELECT o_orderkey, o_orderdate::date AS date, o_totalprice AS price, o_orderpriority AS category
    FROM orders
    """
)
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, orders_csv(spark, sf_dir)).select(
        header("Order.Key").try_cast("long").alias("o_orderkey"),
        F.try_to_date(header(ODD_DATE)).alias("date"),
        header(ODD_PRICE).try_cast("double").alias("price"),
        "category",
    )


@query(
    """
    SELECT o_orderkey, o_orderdate::date AS date, o_totalprice AS price, o_orderpriority AS category
    FROM orders
    """
)
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with types found by reading the whole input."""
    return read_csv(spark, orders_csv(spark, sf_dir), infer=True).select(
        header("Order.Key").cast("long").alias("o_orderkey"),
        header(ODD_DATE).alias("date"),
        header(ODD_PRICE).alias("price"),
        "category",
    )


def orders_csv(spark: SparkSession, sf_dir: str) -> str:
    return write_csv(
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("Order.Key"),
            F.col("o_custkey").alias("not read"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias(ODD_DATE),
            F.col("o_totalprice").alias(ODD_PRICE),
            F.col("o_orderpriority").alias("category"),
        ),
        "csv",
    )


ROLL = """
    SELECT printf('%05d', c_nationkey) AS zip_code, o_orderdate::date AS day, o_totalprice AS amount,
           o_orderstatus, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1500.0 END AS square_feet
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_nationkey > 0 AND o_orderpriority NOT LIKE '4%' AND c_mktsegment <> 'MACHINERY'
"""

ROLL_SALES = f"""
    SELECT zip_code, date_trunc('month', day)::date AS date, amount AS price, square_feet FROM ({ROLL})
    UNION ALL
    SELECT zip_code, date_trunc('month', day + 400)::date, amount * 0.5, square_feet FROM ({ROLL})
    UNION ALL
    SELECT zip_code, date_trunc('month', day + 800)::date, amount * 0.25, square_feet FROM ({ROLL})
    WHERE o_orderstatus <> 'F'
"""


@query(
    " UNION ALL ".join(
        f"""
        SELECT 'MD' AS source, 'allHomes' AS segment, '{measure}' AS measure, zip_code, date,
               quantile_disc({value}, 0.5) AS price
        FROM ({ROLL_SALES}) WHERE price >= 2000
        GROUP BY zip_code, date HAVING quantile_disc({value}, 0.5) IS NOT NULL
        """
        for measure, value in (("price", "price"), ("price_sf", "price / nullif(square_feet, 0)"))
    )
)
def assessor_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an assessor roll: three sales a row, ZIP+4 codes, zero dates."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    day, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    priority = F.col("o_orderpriority")

    def dotted(date: Column) -> Column:
        return F.date_format(date, "yyyy.MM.dd")

    third = F.when(F.col("o_orderstatus") != "F", dotted(F.date_add(day, 800))).otherwise("0000.00.00")
    path = write_csv(
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_orderkey").alias("ACCOUNT: Number (MDP Field: ACCTID. SDAT Field #3)"),
            F.concat(F.col("c_nationkey").cast("string"), F.lit("-0001")).alias(V.ASSESSOR_ZIP),
            dotted(day).alias(V.ASSESSOR_DATE_1),
            price.alias(V.ASSESSOR_PRICE_1),
            dotted(F.date_add(day, 400)).alias(V.ASSESSOR_DATE_2),
            (price * 0.5).alias(V.ASSESSOR_PRICE_2),
            third.alias(V.ASSESSOR_DATE_3),
            (price * 0.25).alias(V.ASSESSOR_PRICE_3),
            F.when(priority == "5-LOW", 0.0).otherwise(1500.0).alias(V.ASSESSOR_SQUARE_FEET),
            F.when(priority.startswith("4"), "OFFICE (09)").otherwise("STRY 2 Story (02)").alias(V.ASSESSOR_STYLE),
            F.when(F.col("c_mktsegment") != "MACHINERY", "DWEL Standard Unit (0001)").alias(V.ASSESSOR_DWELLING),
        ),
        "roll",
    )
    return feeds.assessor_series(feeds.assessor_sales(read_csv(spark, path)), staged=True)


@query(
    """
    SELECT 'RDC' AS source, 'allHomes' AS segment, 'price' AS measure, printf('%05d', o_custkey) AS zip_code,
           date_trunc('month', o_orderdate)::date AS date, o_totalprice AS price FROM orders
    UNION ALL
    SELECT 'RDC', 'allHomes', 'price_sf', printf('%05d', o_custkey), date_trunc('month', o_orderdate)::date,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000 END FROM orders
    """
)
def listing_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_csv(
        table(spark, sf_dir, "orders").select(
            F.date_format("o_orderdate", "yyyyMM").alias("month_date_yyyymm"),
            F.col("o_custkey").alias("postal_code"),
            F.col("o_orderpriority").alias("zip_name"),
            F.col("o_totalprice").alias("median_listing_price"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 1000).alias(
                "median_listing_price_per_square_feet"
            ),
        ),
        "listing",
    )
    return feeds.read_listing(spark, path)


# ---- nested documents ---------------------------------------------------------


def write_documents(spark: SparkSession, sf_dir: str) -> str:
    """Events as provider documents, a folder per metric; globs find them by name.

    The second pair of a document has a price that is null, the third has none.
    """
    day = F.col("ts").cast("date")
    metric = (
        F.when(F.col("event_type") == "click", "MSPAH")
        .when(F.col("event_type") == "view", "MSPFCO")
        .when(F.col("event_type") == "purchase", "MSPFAH")
        .otherwise("MSPFSF")
    )
    text = F.date_format(day, "yyyy-MM-dd")
    documents = table(spark, sf_dir, "events").select(
        F.struct(
            F.format_string("Z%05d_%s", "user_id", metric).alias("dataset_code"),
            F.array(
                F.array(text, F.col("value").cast("string")),
                F.array(text, F.lit(None).cast("string")),
                F.array(text),
            ).alias("data"),
        ).alias("dataset"),
        F.format_string("Z_%s.json", metric).alias("file"),
    )
    path = new_folder(spark, "documents")
    with fixture():
        documents.write.option("ignoreNullFields", False).partitionBy("file").json(path)
    return path


METRIC = """CASE event_type WHEN 'click' THEN 'MSPAH' WHEN 'view' THEN 'MSPFCO'
            WHEN 'purchase' THEN 'MSPFAH' ELSE 'MSPFSF' END"""


@query(
    f"""
    SELECT {METRIC} AS metric, substr(printf('%05d', user_id), 1, 5) AS zip_code, ts::date AS date, value AS price FROM events
    UNION ALL
    SELECT {METRIC}, substr(printf('%05d', user_id), 1, 5), ts::date, NULL FROM events
    UNION ALL
    SELECT {METRIC}, substr(printf('%05d', user_id), 1, 5), ts::date, NULL FROM events
    """
)
def json_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_provider_series(spark, f"{write_documents(spark, sf_dir)}/*Z*_MSP*.json")


SEGMENT_OF_METRIC = """CASE event_type WHEN 'click' THEN 'allHomes' WHEN 'view' THEN 'condos'
            WHEN 'purchase' THEN 'allHomes' ELSE 'sfHomes' END"""
MEASURE_OF_METRIC = "CASE event_type WHEN 'click' THEN 'price' ELSE 'price_sf' END"
PROVIDER_ROW = f"""
    SELECT 'QZ' AS source, {SEGMENT_OF_METRIC} AS segment, {MEASURE_OF_METRIC} AS measure,
           substr(printf('%05d', user_id), 1, 5) AS zip_code, ts::date AS date"""


@query(
    f"""
    {PROVIDER_ROW}, value AS price FROM events
    UNION ALL {PROVIDER_ROW}, NULL FROM events
    UNION ALL {PROVIDER_ROW}, NULL FROM events
    """
)
def provider_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The provider feed, its four metrics given as four globs and read at once."""
    path = write_documents(spark, sf_dir)
    return feeds.read_provider(spark, [f"{path}/*Z*_{metric}.json" for metric in V.PROVIDER_METRICS])


# ---- workbooks ----------------------------------------------------------------

ROWS_PER_BOOK = 5000


def as_workbooks(ledger: DataFrame, titles: list[str]) -> DataFrame:
    """Rows (path, content): the ledger cut into workbooks, as reading files gives.

    Columns keep their order; dates become day numbers. Rows are spread evenly
    first, so that every core binds and later reads its share.
    """
    ledger = ledger.repartition(ledger.sparkSession.sparkContext.defaultParallelism)
    names = ledger.columns
    dates = {i for i, f in enumerate(ledger.schema.fields) if f.dataType.typeName() == "date"}
    cells = ledger.select(
        *[
            F.date_diff(F.col(f"`{n}`"), F.lit("1899-12-30").cast("date")).alias(n)
            if i in dates
            else F.col(f"`{n}`")
            for i, n in enumerate(names)
        ]
    )
    size = ROWS_PER_BOOK

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []

        def book(rows: list) -> pa.RecordBatch:
            content = book_writer.write(titles, names, rows, dates)
            return pa.RecordBatch.from_pydict({"path": ["derived"], "content": [content]})

        for batch in batches:
            held.extend(zip(*[column.to_pylist() for column in batch.columns]))
            while len(held) >= size:
                yield book(held[:size])
                held = held[size:]
        if held:
            yield book(held)

    return cells.mapInArrow(bind, "path string, content binary")


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ledger rows, with the classes of several market segments."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    priority = F.substring("o_orderpriority", 1, 1)
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.when(priority == "1", "01 ONE FAMILY DWELLINGS")
        .when(priority == "2", "02 TWO FAMILY DWELLINGS")
        .when(priority == "3", "04 TAX CLASS 1 CONDOS")
        .when(priority == "4", "13 CONDOS - ELEVATOR APARTMENTS")
        .otherwise("21 OFFICE BUILDINGS")
        .alias("BUILDING CLASS CATEGORY"),
        F.col("c_nationkey").cast("double").alias("ZIP CODE"),
        F.lit(1.0).alias("TOTAL UNITS"),
        F.when(F.col("o_orderstatus") == "O", 0.0)
        .when(F.col("o_orderstatus") == "F", 1250.0)
        .alias("GROSS SQUARE FEET"),
        F.col("o_totalprice").alias("SALE PRICE"),
        F.col("o_orderdate").cast("date").alias("SALE DATE"),
    )


def ledger_from_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger by way of workbooks with two layouts, data from A5 or from A6.

    Names and types come from the header of the older ones and are imposed on
    the others.
    """
    rows = ledger_rows(spark, sf_dir)
    newer = F.coalesce(F.year("SALE DATE") >= 1998, F.lit(False))
    with fixture():
        old_books = stage(as_workbooks(rows.where(~newer), ["SALES", "", "BY CLASS"]), "books")
        new_books = stage(as_workbooks(rows.where(newer), ["SALES", "", "", "BY CLASS"]), "books")
    schema = infer_schema(old_books, "0!A4")
    older = read_sheets(old_books, schema, "0!A5")
    return older.unionByName(read_sheets(new_books, schema, "0!A6", empty_as_null=False))


LEDGER = """
    SELECT CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '01 ONE FAMILY DWELLINGS'
                WHEN '2' THEN '02 TWO FAMILY DWELLINGS' WHEN '3' THEN '04 TAX CLASS 1 CONDOS'
                WHEN '4' THEN '13 CONDOS - ELEVATOR APARTMENTS' ELSE '21 OFFICE BUILDINGS' END AS building_class,
           c_nationkey AS zip, CASE o_orderstatus WHEN 'O' THEN 0.0 WHEN 'F' THEN 1250.0 END AS square_feet,
           o_totalprice AS price, o_orderdate::date AS day
    FROM orders JOIN customer ON o_custkey = c_custkey
"""


@query(
    f"""
    SELECT building_class, cast(zip AS double) AS zip, cast(1 AS double) AS units,
           cast(square_feet AS double) AS square_feet, price, day FROM ({LEDGER})
    """
)
def sheet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["building_class", "zip", "units", "square_feet", "price", "day"]
    return ledger_from_workbooks(spark, sf_dir).toDF(*names)


LEDGER_SALES = f"""
    SELECT printf('%05d', zip) AS zip_code, date_trunc('month', day)::date AS date, price,
           price / nullif(square_feet, 0) AS price_sf, substr(building_class, 1, 2) AS code
    FROM ({LEDGER}) WHERE zip > 0 AND price >= 2000
"""
LEDGER_CODES = {
    V.ALL_HOMES: V.ALL_HOMES_CODES,
    V.CONDOS: V.CONDO_CODES,
    V.SINGLE_FAMILY: V.SINGLE_FAMILY_CODES,
}


@query(
    " UNION ALL ".join(
        f"""
        SELECT 'NYC' AS source, '{segment}' AS segment, '{measure}' AS measure, zip_code, date,
               quantile_disc({measure}, 0.5) AS price
        FROM ({LEDGER_SALES}) WHERE code IN ({", ".join(repr(c) for c in codes)})
        GROUP BY zip_code, date HAVING quantile_disc({measure}, 0.5) IS NOT NULL
        """
        for segment, codes in LEDGER_CODES.items()
        for measure in (V.TOTAL, V.PER_SQUARE_FOOT)
    )
)
def ledger_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = ledger_from_workbooks(spark, sf_dir)
    return feeds.ledger_series(feeds.ledger_sales(ledger), staged=True)
