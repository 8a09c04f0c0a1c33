"""Record types shared by all feeds."""

from __future__ import annotations

from pyspark.sql import types as T

#: What every output table holds.
PRICE_SERIES = T.StructType(
    [
        T.StructField("zip_code", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("price", T.DoubleType()),
    ]
)

#: The unified form: one row per source, segment, measure, area and month.
UNIFIED_SERIES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("measure", T.StringType()),
        *PRICE_SERIES.fields,
    ]
)

#: One sale, from either the assessor roll or the sales ledger. Columns a feed
#: does not know stay NULL.
SALE = T.StructType(
    [
        T.StructField("zip_code", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("price_sf", T.DoubleType()),
        T.StructField("units", T.DoubleType()),
        T.StructField("building_code", T.StringType()),
        T.StructField("building_class", T.StringType()),
        T.StructField("type1", T.StringType()),
        T.StructField("code1", T.StringType()),
        T.StructField("type2", T.StringType()),
        T.StructField("code2", T.StringType()),
    ]
)

#: One provider document. A pair mixes a date string with a number, so its
#: elements are read as strings and the price is cast later.
PROVIDER_DOCUMENT = T.StructType(
    [
        T.StructField(
            "dataset",
            T.StructType(
                [
                    T.StructField("dataset_code", T.StringType()),
                    T.StructField("data", T.ArrayType(T.ArrayType(T.StringType()))),
                ]
            ),
        )
    ]
)

#: The ledger columns the series need, under the names the workbooks use.
LEDGER_SHEET = T.StructType(
    [
        T.StructField("BUILDING CLASS CATEGORY", T.StringType()),
        T.StructField("ZIP CODE", T.DoubleType()),
        T.StructField("TOTAL UNITS", T.DoubleType()),
        T.StructField("GROSS SQUARE FEET", T.DoubleType()),
        T.StructField("SALE PRICE", T.DoubleType()),
        T.StructField("SALE DATE", T.DateType()),
    ]
)
