"""Medians whose state is stored, so that a further delivery needs no earlier sale.

A delivery becomes one row per group: its number of values and, per measure, a quantile
sketch of bounded size (KLL). States merge: those of a delivery with those stored before, or of
many deliveries at once. The store is a folder partitioned by delivery. Delivering again under
one name replaces what was there, so a run can be repeated.

Ranks are off by about ``1.8 / k ** 0.9`` of a group's values, whatever their number: a third
of a percent at the default ``k``. NULL is no value; NaN is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelab.operators.medians import Measure

#: Size of a sketch: values it keeps are a small multiple of it.
SKETCH_K = 1_024

#: Deliveries in the store beyond which ``compacted`` is worth it.
MANY = 100


def _number(measure: Measure) -> Column:
    value = measure.column().cast("double")
    return F.when(~F.isnan(value), value)


def median_states(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[Measure], k: int = SKETCH_K
) -> DataFrame:
    """keys, and per measure ``n_<name>`` and ``state_<name>``; map-side merged, in one pass.

    A group without a value of a measure has n 0 and a NULL state.
    """
    aggregates = []
    for measure in measures:
        number = _number(measure)
        n = F.count(number)
        aggregates += [
            n.alias(f"n_{measure.name}"),
            F.when(n > 0, F.kll_sketch_agg_double(number, k)).alias(f"state_{measure.name}"),
        ]
    return rows.groupBy(*keys).agg(*aggregates)


def merged_states(states: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per group, of rows as from ``median_states``."""
    aggregates = []
    for name in names:
        n = F.sum(f"n_{name}")
        aggregates += [
            n.alias(f"n_{name}"),
            F.when(n > 0, F.kll_merge_agg_double(f"state_{name}")).alias(f"state_{name}"),
        ]
    return states.groupBy(*keys).agg(*aggregates)


def state_quantiles(
    states: DataFrame, keys: Sequence[str], names: Sequence[str], share: float = 0.5
) -> DataFrame:
    """keys, and per measure its approximate quantile, NULL without values, and ``n_<name>``."""
    columns = []
    for name in names:
        state = F.col(f"state_{name}")
        quantile = F.kll_sketch_get_quantile_double(state, F.lit(share))
        columns += [F.when(state.isNotNull(), quantile).alias(name), F.col(f"n_{name}")]
    return states.select(*keys, *columns)


@dataclass(frozen=True)
class MedianStore:
    """A folder, on storage that all executors reach, of states by delivery."""

    path: str
    keys: tuple[str, ...]
    names: tuple[str, ...]

    def deliver(
        self, rows: DataFrame, delivery: str, measures: Sequence[Measure], k: int = SKETCH_K
    ) -> None:
        """Store a delivery's states. Only its own sales are read, and no other delivery.

        A delivery of that name is replaced, and goes if there are no rows.
        """
        if tuple(m.name for m in measures) != self.names:
            raise ValueError(f"measures of this store are {self.names}")
        self._write(median_states(rows, self.keys, measures, k), delivery)

    def _write(self, states: DataFrame, delivery: str) -> None:
        # Its own folder is replaced as a whole; names are hashed, as they may hold any sign.
        folder = f"{self.path}/delivery={_folder_name(delivery)}"
        states.select(F.lit(delivery).alias("delivery_name"), "*").write.mode("overwrite").parquet(folder)

    def states(self, spark: SparkSession) -> DataFrame:
        """One merged state per group of all deliveries."""
        stored = spark.read.option("basePath", self.path).parquet(f"{self.path}/delivery=*")
        return merged_states(stored, self.keys, self.names)

    def medians(self, spark: SparkSession) -> DataFrame:
        """keys, and per measure its median and number of values, over all deliveries."""
        return state_quantiles(self.states(spark), self.keys, self.names)

    def deliveries(self, spark: SparkSession) -> DataFrame:
        """delivery_name, n_groups of what is stored; for ``compacted``, when there are ``MANY``."""
        stored = spark.read.option("basePath", self.path).parquet(f"{self.path}/delivery=*")
        return stored.groupBy("delivery_name").agg(F.count("*").alias("n_groups"))

    def compacted(self, spark: SparkSession, path: str) -> MedianStore:
        """A store elsewhere with all deliveries merged into one; this one stays as it is."""
        whole = MedianStore(path, self.keys, self.names)
        whole._write(self.states(spark), "compacted")
        return whole


def _folder_name(delivery: str) -> str:
    import hashlib

    return hashlib.sha256(delivery.encode()).hexdigest()[:32]
