"""Feeds read with their malformed records kept apart, instead of becoming NULL silently.

A record is parsed once and written with the file it is from; good rows go on, the others keep
their text and a reason. ``file_report`` counts both per file.

Reasons for JSON: ``not_json`` (truncated, say) or ``types`` (JSON, but some value does not fit
the schema). For CSV: ``fields`` (more or fewer than the header has) or ``types``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.plans.staging import stage

RECORD = "_malformed"
FILE = "_file"


@dataclass(frozen=True)
class Checked:
    """``good``: the schema's columns; ``malformed``: file, reason, record.

    ``parsed`` is both, as staged.
    """

    good: DataFrame
    malformed: DataFrame
    parsed: DataFrame

    def file_report(self) -> DataFrame:
        """file, n_good and n_malformed of every file with a record, counted map-side."""
        return self.parsed.groupBy(F.col(FILE).alias("file")).agg(
            F.count_if(F.col(RECORD).isNull()).alias("n_good"),
            F.count_if(F.col(RECORD).isNotNull()).alias("n_malformed"),
        )

    def reasons(self) -> DataFrame:
        """file, reason, n_rows."""
        return self.malformed.groupBy("file", "reason").agg(F.count("*").alias("n_rows"))


def _checked(raw: DataFrame, schema: T.StructType, reason: Column) -> Checked:
    # Written first: Spark parses again, and differently, for each set of columns.
    parsed = stage(raw.withColumn(FILE, F.col("_metadata.file_path")), "checked-records")
    good = parsed.where(F.col(RECORD).isNull()).select(*[F.col(f"`{n}`") for n in schema.names])
    malformed = parsed.where(F.col(RECORD).isNotNull()).select(
        F.col(FILE).alias("file"), reason.alias("reason"), F.col(RECORD).alias("record")
    )
    return Checked(good, malformed, parsed)


def read_json_checked(
    spark: SparkSession, paths: str | list[str], schema: T.StructType
) -> Checked:
    """JSON documents, one per line; blank lines are no records."""
    whole = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    raw = (
        spark.read.schema(whole)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .json(paths)
    )
    is_json = F.try_parse_json(F.col(RECORD)).isNotNull()
    return _checked(raw, schema, F.when(is_json, "types").otherwise("not_json"))


def read_csv_checked(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, delimiter: str = ","
) -> Checked:
    """CSV files with the schema's columns in its order, under a header line.

    A header with other names fails, as in ``read_csv``. Fields in quotes may hold the
    delimiter; records with line ends inside quotes are not for this reader.
    """
    whole = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    raw = (
        spark.read.schema(whole)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", delimiter)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .csv(paths)
    )
    bare = F.regexp_replace(RECORD, '"([^"\\\\\\\\]|\\\\\\\\.|"")*"', "")
    fields = F.char_length(bare) - F.char_length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1
    reason = F.when(fields != len(schema.fields), "fields").otherwise("types")
    return _checked(raw, schema, reason)
