"""Keyed replacement in a table of months: a delivery may come late, again, or twice.

The table is partitioned by month. Only the months that a delivery touches are read and
written again (dynamic partition overwrite); per key the latest row stays. What is written
is staged before, so no folder is read while it is replaced, and a run that is repeated after
any failure ends with the same table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.functions import month_start
from pricelab.plans.staging import stage

#: The folder column; its text keeps Spark from guessing a type.
MONTH = "month_of"


def latest_rows(rows: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Per key the row with the largest ``version``; of equal ones the largest other values.

    One map-side merged maximum, so a key that repeats often does no harm. NULL keys are
    keys, NULL versions are older than any other.
    """
    others = [name for name in rows.columns if name not in keys and name != version]
    newest = F.max(F.struct(F.col(version), *[F.col(f"`{name}`") for name in others])).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(
        *[
            F.col(name) if name in keys else F.col("_newest").getField(name).alias(name)
            for name in rows.columns
        ]
    )


@dataclass(frozen=True)
class MonthlyTable:
    """A Parquet table in a folder all executors reach, with a date among its keys."""

    path: str
    keys: tuple[str, ...] = ("zip_code", "date")
    date: str = "date"
    version: str = "version"

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop(MONTH)

    def exists(self, spark: SparkSession) -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def upsert(self, delivery: DataFrame) -> int:
        """Merge the delivery's rows by key; return how many months were written again.

        A row replaces one of its key if its version is not older. The months of a delivery,
        a few hundred at most, are listed in the driver, so that others are not even opened.
        Rows without a date are a month of their own.
        """
        if missing := {*self.keys, self.date, self.version} - set(delivery.columns):
            raise ValueError(f"a delivery needs the columns {sorted(missing)}")
        spark, month = delivery.sparkSession, self._month()
        fresh = stage(delivery.withColumn(MONTH, month), "delivery")
        months = [row[0] for row in fresh.select(MONTH).distinct().collect()]
        if not months:
            return 0
        rows = fresh
        if self.exists(spark):
            stored = spark.read.schema(fresh.schema).parquet(self.path)
            rows = stored.where(F.col(MONTH).isin(months)).unionByName(fresh)
        merged = stage(
            latest_rows(rows.drop(MONTH), self.keys, self.version).withColumn(MONTH, month), "merged-months"
        )
        (
            merged.repartition(MONTH)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH)
            .parquet(self.path)
        )
        return len(months)

    def _month(self):
        text = F.date_format(month_start(F.col(self.date)), "yyyy-MM")
        return F.coalesce(F.concat(F.lit("m"), text), F.lit("none"))
