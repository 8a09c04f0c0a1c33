"""Workbooks (``.xlsx``) as DataFrames.

Spark lists and reads the files, so any Hadoop path works, and hands each
workbook as bytes to one task. There the cells are streamed out as texts; types
are given to them by Spark expressions. Legacy ``.xls`` files have to be
converted first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.sources import workbook

# Executors need not have the package installed.
cloudpickle.register_pickle_by_value(workbook)

ROWS_PER_BATCH = 4096


def open_workbooks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Rows (path, content), one per workbook."""
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def read_sheets(
    books: DataFrame,
    schema: T.StructType | None = None,
    data_address: str = "0!A1",
    header: bool = False,
    empty_as_null: bool = True,
) -> DataFrame:
    """Rows of all ``books``, from the cell ``sheet!cell`` to the right and down.

    With ``header`` the address is that of the header row, which then gives the
    names unless a schema is imposed. ``empty_as_null=False`` keeps empty text
    cells as empty texts.
    """
    if schema is None:
        if not header:
            raise ValueError("without a header row the sheets need a schema")
        schema = infer_schema(books, data_address)
    sheet, first_row, first_column = workbook.parse_address(data_address)
    first_row += int(header)
    width = len(schema.fields)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"c{i}" for i in range(width)]

        def batch(held: list[list[str]]) -> pa.RecordBatch:
            columns = [pa.array(column, pa.string()) for column in zip(*held)]
            return pa.RecordBatch.from_arrays(columns, names)

        for incoming in batches:
            for content in incoming.column("content"):
                held = []
                for cells in workbook.rows(
                    content.as_py(), sheet, first_row, first_column, width
                ):
                    held.append([text for text, _ in cells])
                    if len(held) == ROWS_PER_BATCH:
                        yield batch(held)
                        held = []
                if held:
                    yield batch(held)

    texts = books.select("content").mapInArrow(extract, ", ".join(f"c{i} string" for i in range(width)))
    return texts.select(
        *[_typed(F.col(f"c{i}"), f, empty_as_null) for i, f in enumerate(schema.fields)]
    )


def infer_schema(books: DataFrame, header_address: str) -> T.StructType:
    """Names from the header row, types from the data below it, of all workbooks.

    A column of several types is text, one without data too. The workbooks must have the
    same header; to impose that of one on others, give that one alone.
    """
    sheet, header_row, first_column = workbook.parse_address(header_address)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for incoming in batches:
            for content in incoming.column("content"):
                found = workbook.column_types(content.as_py(), sheet, header_row, first_column)
                yield pa.RecordBatch.from_pylist(
                    [{"place": i, "name": n, "type": t} for i, (n, t) in enumerate(found)],
                    pa.schema([("place", pa.int32()), ("name", pa.string()), ("type", pa.string())]),
                )

    looks = books.select("content").mapInArrow(look, "place int, name string, type string")
    columns = (
        looks.groupBy("place")
        .agg(
            F.count("*").alias("books"),
            F.min("name").alias("name"),
            F.max("name").alias("last"),
            F.collect_set(F.when(F.col("type") != "", F.col("type"))).alias("types"),
        )
        .orderBy("place")
        .collect()
    )
    if any(c.name != c.last or c.books != columns[0].books for c in columns):
        raise ValueError("the workbooks have different headers")
    kinds = {"double": T.DoubleType(), "date": T.DateType(), "string": T.StringType()}
    return T.StructType(
        [
            T.StructField(c.name, kinds[c.types[0]] if len(c.types) == 1 else T.StringType())
            for c in columns
        ]
    )


def _typed(text: Column, field: T.StructField, empty_as_null: bool) -> Column:
    if isinstance(field.dataType, T.StringType):
        value = F.when(F.trim(text) != "", text) if empty_as_null else text
    elif isinstance(field.dataType, T.DateType):
        # Dates are stored as days since 1899-12-30, or as texts.
        days = F.floor(text.try_cast("double")).cast("int")
        value = F.coalesce(F.date_add(F.lit("1899-12-30").cast("date"), days), F.try_to_date(text))
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        # The fraction of a day is the time, on the clock of the session.
        seconds = F.round(text.try_cast("double") * 86400, 3).try_cast("decimal(18,6)")
        start = F.lit("1899-12-30").cast("timestamp_ntz")
        serial = start + F.make_dt_interval(secs=seconds)
        value = F.coalesce(serial, text.try_cast("timestamp_ntz")).cast(field.dataType)
    elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        value = text.try_cast("double").try_cast(field.dataType)
    else:
        raise ValueError(f"cells cannot be read as {field.dataType.simpleString()}")
    return value.alias(field.name)
