"""The four feeds, from their files to series in the unified form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab import fixed_values as V
from pricelab.functions import (
    bracket_code,
    class_code,
    dotted_date,
    first_token,
    is_known_zip,
    month_start,
    to_amount,
    unit_price,
    yyyymm_date,
    zip_from_double,
    zip_from_int,
    zip_from_text,
)
from pricelab.operators.sales import as_sales, is_housing, market_sales, unpivot_sales
from pricelab.operators.segments import AREA_MONTH, ledger_segments, segment_medians
from pricelab.operators.unify import as_series
from pricelab.sinks.tables import FolderTarget, JdbcTarget, fan_out
from pricelab.sources.delimited import header, read_csv
from pricelab.sources.documents import read_provider_series

# ---- assessor roll: three sales per property -------------------------------


def assessor_sales(roll: DataFrame) -> DataFrame:
    """Housing sales of the roll, one row per sale.

    The roll keeps the last three sales of a property, so older sales of often
    sold ones are missing.
    """
    area = to_amount(header(V.ASSESSOR_SQUARE_FEET))
    style, dwelling = header(V.ASSESSOR_STYLE), header(V.ASSESSOR_DWELLING)
    properties = roll.select(
        zip_from_text(header(V.ASSESSOR_ZIP)).alias("zip_code"),
        area.alias("square_feet"),
        first_token(style).alias("type1"),
        bracket_code(style).alias("code1"),
        first_token(dwelling).alias("type2"),
        bracket_code(dwelling).alias("code2"),
        *[
            column.alias(name)
            for i, (d, p) in enumerate(
                [
                    (V.ASSESSOR_DATE_1, V.ASSESSOR_PRICE_1),
                    (V.ASSESSOR_DATE_2, V.ASSESSOR_PRICE_2),
                    (V.ASSESSOR_DATE_3, V.ASSESSOR_PRICE_3),
                ],
                start=1,
            )
            for name, column in (
                (f"date{i}", month_start(dotted_date(header(d)))),
                (f"price{i}", to_amount(header(p))),
            )
        ],
    ).where(is_known_zip(F.col("zip_code")) & is_housing(F.col("type1"), F.col("type2")))
    sales = unpivot_sales(
        properties,
        [(F.col(f"date{i}"), F.col(f"price{i}")) for i in (1, 2, 3)],
        ["zip_code", "square_feet", "type1", "code1", "type2", "code2"],
    )
    priced = sales.withColumn("price_sf", unit_price(F.col("price"), F.col("square_feet")))
    return as_sales(market_sales(priced))


def assessor_series(sales: DataFrame, **options) -> DataFrame:
    columns = sales.select(*AREA_MONTH, V.TOTAL, V.PER_SQUARE_FOOT)
    medians = segment_medians(columns, {V.ALL_HOMES: None}, **options)
    return as_series(medians, source=V.ASSESSOR)


# ---- sales ledger: workbooks ------------------------------------------------


def ledger_sales(ledger: DataFrame) -> DataFrame:
    """Market sales of the ledger. A sale may be of a building with many units."""
    price, area = header("SALE PRICE"), header("GROSS SQUARE FEET")
    category = header("BUILDING CLASS CATEGORY")
    sales = ledger.select(
        zip_from_double(header("ZIP CODE")).alias("zip_code"),
        month_start(header("SALE DATE")).alias("date"),
        price.cast("double").alias("price"),
        unit_price(price, area).alias("price_sf"),
        header("TOTAL UNITS").alias("units"),
        class_code(category).alias("building_code"),
        category.alias("building_class"),
    )
    known = sales.where(is_known_zip(F.col("zip_code")))
    return as_sales(known.where(F.col("price") >= V.PRICE_FLOOR))


def ledger_series(sales: DataFrame, **options) -> DataFrame:
    columns = sales.select(*AREA_MONTH, V.TOTAL, V.PER_SQUARE_FOOT, "building_code")
    medians = segment_medians(columns, ledger_segments(F.col("building_code")), **options)
    return as_series(medians, source=V.LEDGER)


# ---- listing metrics --------------------------------------------------------


def listing_series(metrics: DataFrame) -> DataFrame:
    """Both price metrics from one read, as they come: no filter, no aggregation."""
    columns = {
        V.TOTAL: "median_listing_price",
        V.PER_SQUARE_FOOT: "median_listing_price_per_square_feet",
    }
    entries = [
        F.struct(F.lit(measure).alias("measure"), to_amount(F.col(name)).alias("price"))
        for measure, name in columns.items()
    ]
    rows = metrics.select(
        zip_from_int(F.col("postal_code").try_cast("long")).alias("zip_code"),
        yyyymm_date(F.col("month_date_yyyymm")).alias("date"),
        F.inline(F.array(*entries)),
    )
    return as_series(rows, source=V.LISTING, segment=V.ALL_HOMES)


def read_listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return listing_series(read_csv(spark, paths))


# ---- provider series --------------------------------------------------------


def provider_series(pairs: DataFrame, others: str = "raise") -> DataFrame:
    """Provider rows with segment and measure for their metric.

    A metric without them is an error, unless ``others`` is ``drop``.
    """
    if others not in ("raise", "drop"):
        raise ValueError(f"others must be 'raise' or 'drop', not {others!r}")
    segment, measure = F.lit(None).cast("string"), F.lit(None).cast("string")
    for metric, (its_segment, its_measure) in V.PROVIDER_METRICS.items():
        segment = F.when(F.col("metric") == metric, its_segment).otherwise(segment)
        measure = F.when(F.col("metric") == metric, its_measure).otherwise(measure)
    is_known = F.coalesce(F.col("metric").isin(list(V.PROVIDER_METRICS)), F.lit(False))
    if others == "drop":
        pairs = pairs.where(is_known)
    else:
        unknown = F.raise_error(F.concat(F.lit("unknown metric: "), F.coalesce("metric", F.lit("NULL"))))
        segment = F.when(is_known, segment).otherwise(unknown.cast("string"))
    labelled = pairs.withColumn("segment", segment).withColumn("measure", measure)
    return as_series(labelled, source=V.PROVIDER)


def read_provider(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return provider_series(read_provider_series(spark, paths))


# ---- tables -----------------------------------------------------------------


def series_tables(
    source: str, segments: Sequence[str], measures: Sequence[str] = (V.TOTAL, V.PER_SQUARE_FOOT)
) -> dict[str, Column]:
    """Table name -> its rows, such as ``condosBySFNYC`` -> condos, price_sf."""
    return {
        f"{segment}{V.TABLE_SUFFIX[measure]}{source}": (F.col("segment") == segment)
        & (F.col("measure") == measure)
        for segment in segments
        for measure in measures
    }


def source_tables(source: str) -> dict[str, Column]:
    """All output tables of a source."""
    if source == V.PROVIDER:
        tables: dict[str, Column] = {}
        for segment, measure in V.PROVIDER_METRICS.values():
            tables.update(series_tables(source, [segment], [measure]))
        return tables
    if source == V.LEDGER:
        return series_tables(source, [V.ALL_HOMES, V.CONDOS, V.SINGLE_FAMILY])
    return series_tables(source, [V.ALL_HOMES])


def write_series(
    series: DataFrame, source: str, target: JdbcTarget | FolderTarget, mode: str = "overwrite"
) -> int:
    """Write a source's series to its tables; return how many rows none of them takes."""
    return fan_out(series, target, source_tables(source), mode)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Name frames for use in SQL texts of their session."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
