"""CSV files with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """Columns by header name.

    Without a schema all columns are texts, for which only one header line is
    read up front; wide files are parsed for the selected columns only. ``infer``
    reads the whole input once more to find types. Files whose header has the read columns
    in another order, or under other names, fail: read each layout on its own.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(paths)


def header(name: str) -> Column:
    """A column whose name may hold dots, blanks, brackets, ``#`` or ``/``."""
    return F.col("`" + name.replace("`", "``") + "`")
