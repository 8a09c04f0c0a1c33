"""What the operators share: reading columns, splitting batches, session settings."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows Spark hands to Python at once. Texts may be long, so this is far below the default.
BATCH_ROWS = 512

#: Bytes of a side that may be broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20

#: Characters worked on at once inside a task; a longer text is worked on alone.
CHUNK_CHARS = 400_000


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: batches of few rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of so many narrow rows, for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, empty where NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def chunks(
    batches: Iterator[pd.DataFrame], column: str = "text", chars: int = CHUNK_CHARS
) -> Iterator[pd.DataFrame]:
    """Runs of rows with about ``chars`` characters of ``column`` each."""
    for batch in batches:
        ends = batch[column].str.len().cumsum().to_numpy()
        start, done = 0, 0
        for at, end in enumerate(ends):
            if end - done >= chars or at + 1 == len(ends):
                yield batch.iloc[start : at + 1].reset_index(drop=True)
                start, done = at + 1, end


def width(column: Column, kind: T.DataType) -> Column:
    """About the bytes of a value in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column) + 16
    if isinstance(kind, T.ArrayType):
        flat = not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType))
        return F.size(column) * 16 + 16 if flat else F.octet_length(F.to_json(column)) + 16
    return F.lit(16)


def byte_size(rows: DataFrame) -> int:
    """About the bytes of all rows in memory, summed by Spark."""
    widths = [F.coalesce(width(F.col(f"`{f.name}`"), f.dataType), F.lit(16)) for f in rows.schema.fields]
    return rows.select(reduce(Column.__add__, widths).alias("_w")).agg(F.sum("_w")).first()[0] or 0


def matched(rows: DataFrame, few: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be NULL; ``few`` (staged) is broadcast if its bytes are few."""
    small = byte_size(few) <= BROADCAST_BYTES
    other = few.withColumnsRenamed({key: f"_of{key}" for key in keys})
    same = " AND ".join(f"{key} <=> _of{key}" for key in keys)
    joined = rows.join(F.broadcast(other) if small else other, F.expr(same), how)
    return joined.drop(*[f"_of{key}" for key in keys])


def for_pandas(rows: DataFrame) -> DataFrame:
    """Whole numbers as text: pandas would round large ones beside a NULL.

    ``restored`` gives the types back.
    """
    whole = ("tinyint", "smallint", "int", "bigint")
    return rows.select(*[F.col(n).cast("string") if t in whole else n for n, t in rows.dtypes])


def schema_of(rows: DataFrame, *added: str, without: str = "") -> str:
    """The columns as a schema text, and more after them."""
    return ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes if n != without), *added])


def restored(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Columns that ``like`` has too get its types."""
    kinds = dict(like.dtypes)
    return rows.select(
        *[F.col(n).cast(kinds[n]) if kinds.get(n, t) != t else F.col(n) for n, t in rows.dtypes]
    )
