"""Series tables in a database (JDBC) or in a folder of Parquet tables.

Both take the save modes ``errorifexists`` (the default), ``append``,
``overwrite`` and ``ignore``.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.plans.staging import stage

DEFAULT_MODE = "errorifexists"


@dataclass(frozen=True)
class JdbcTarget:
    """Connection settings; user and password come from the environment.

    ``max_connections`` bounds how many tasks write at once. A task that is lost
    after its rows were committed and runs again would append them twice, so
    ``append`` should go to a table the database can check for repeated keys.
    """

    host: str
    database: str
    port: int = 5432
    product: str = "postgresql"
    driver: str = "org.postgresql.Driver"
    user_variable: str = "PRICELAB_DB_USER"
    password_variable: str = "PRICELAB_DB_PASSWORD"
    batch_size: int = 10_000
    max_connections: int = 16
    extra: Mapping[str, str] = field(default_factory=dict)

    @property
    def url(self) -> str:
        return f"jdbc:{self.product}://{self.host}:{self.port}/{self.database}"

    @property
    def properties(self) -> dict[str, str]:
        settings = {
            "driver": self.driver,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.max_connections),
            **self.extra,
        }
        for name, variable in (("user", self.user_variable), ("password", self.password_variable)):
            if variable in os.environ:
                settings[name] = os.environ[variable]
        return settings

    def write(self, df: DataFrame, table: str, mode: str = DEFAULT_MODE) -> None:
        df.write.mode(mode).jdbc(self.url, table, properties=self.properties)


@dataclass(frozen=True)
class FolderTarget:
    """One Parquet table per name under a folder all executors reach."""

    path: str

    def write(self, df: DataFrame, table: str, mode: str = DEFAULT_MODE) -> None:
        df.write.mode(mode).parquet(f"{self.path}/{table}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.path}/{table}")


def fan_out(
    df: DataFrame,
    target: JdbcTarget | FolderTarget,
    tables: Mapping[str, Column],
    mode: str = "overwrite",
    columns: tuple[str, ...] = ("zip_code", "date", "price"),
    at_once: int = 3,
) -> int:
    """Write the rows of each table's condition; return how many rows no table takes.

    ``df`` is computed once and written in a folder per table, so that each table reads its
    own rows only. A row may go to several tables. The tables are independent and small next to their sources, so ``at_once``
    of them are written at the same time. ``overwrite`` is the default here, so
    that a run can be repeated.
    """
    named = [F.when(where, F.lit(table)) for table, where in tables.items()]
    its_tables = F.array_compact(F.array(*named))
    dealt = df.withColumn("_table", F.explode_outer(its_tables))
    once = stage(dealt.select(*columns, "_table"), "fan-out", partition_by="_table")

    def write(table: str) -> None:
        target.write(once.where(F.col("_table") == table).select(*columns), table, mode)

    with ThreadPoolExecutor(at_once) as writers:
        list(writers.map(write, tables))
    return once.where(F.col("_table").isNull()).count()
