"""A price index from repeated sales of the same property.

Each two consecutive sales of a property, in different periods, say how much prices rose between
the two: log(price) rose by the sum of the index's steps. The index of an area is the least
squares fit of all its pairs. Pairs are found by one shuffle on the property and summed per
area and two periods, which is all that the normal equations need: a weighted graph over
periods, whose Laplacian is their matrix. Its size is bounded by the periods of an area,
a few hundred months, not by the sales; each area's is solved in its own task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INDEX = "period date, index double, n_pairs long, base date"


def sale_pairs(
    sales: DataFrame, property_keys: Sequence[str], area: str, period: Column, price: Column, order: Sequence[str]
) -> DataFrame:
    """area, from_period, to_period, rise: consecutive sales of a property in two periods.

    Sales of one property go by ``order``; those of one period count with the last. Sales
    without a period or a price above 0 are left out. A property has few sales; so few
    that they meet in a window.
    """
    known = sales.select(
        *property_keys, area, *[c for c in order if c not in property_keys and c != area],
        period.alias("_period"), F.when(price > 0, F.ln(price)).alias("_log"),
    ).where("_period IS NOT NULL AND _log IS NOT NULL")
    in_period = Window.partitionBy(*property_keys, area, "_period").orderBy(*[F.desc(c) for c in order])
    last = known.withColumn("_place", F.row_number().over(in_period)).where("_place = 1")
    by_time = Window.partitionBy(*property_keys, area).orderBy("_period")
    return last.select(
        area,
        F.lag("_period").over(by_time).alias("from_period"),
        F.col("_period").alias("to_period"),
        (F.col("_log") - F.lag("_log").over(by_time)).alias("rise"),
    ).where("from_period IS NOT NULL")


def fitted_index(edges: pd.DataFrame) -> pd.DataFrame:
    """Least squares per connected set of periods; the first of a set is its base, at 1.

    ``edges``: from_period, to_period, n (pairs), rise (their sum).
    """
    periods = np.unique(np.concatenate((edges["from_period"], edges["to_period"])))
    start, end = (np.searchsorted(periods, edges[name]) for name in ("from_period", "to_period"))
    n, rise = edges["n"].to_numpy(float), edges["rise"].to_numpy(float)
    size = len(periods)
    laplacian, right, pairs = np.zeros((size, size)), np.zeros(size), np.zeros(size, "int64")
    np.add.at(laplacian, (start, start), n)
    np.add.at(laplacian, (end, end), n)
    np.add.at(laplacian, (start, end), -n)
    np.add.at(laplacian, (end, start), -n)
    np.add.at(right, end, rise)
    np.add.at(right, start, -rise)
    np.add.at(pairs, start, edges["n"].to_numpy("int64"))
    np.add.at(pairs, end, edges["n"].to_numpy("int64"))
    base = np.arange(size)  # of each period the first period that it is connected to
    while True:
        least = np.where(laplacian != 0, base[None, :], size).min(axis=1)
        if (least == base).all():
            break
        base = np.minimum(base, least)
    level, free = np.zeros(size), base != np.arange(size)
    if free.any():
        level[free] = np.linalg.solve(laplacian[np.ix_(free, free)], right[free])
    return pd.DataFrame(
        {"period": periods, "index": np.exp(level), "n_pairs": pairs, "base": periods[base]}
    )


def repeat_sales_index(
    sales: DataFrame,
    property_keys: Sequence[str],
    area: str,
    period: Column,
    price: Column,
    order: Sequence[str],
) -> DataFrame:
    """area, period, index, n_pairs, base: one row per period of an area that has a pair.

    Periods that no chain of pairs connects have bases of their own; their levels cannot be
    compared.
    """
    edges = (
        sale_pairs(sales, property_keys, area, period, price, order)
        .groupBy(area, "from_period", "to_period")
        .agg(F.count("*").alias("n"), F.sum("rise").alias("rise"))
    )
    kind = sales.schema[area].dataType.simpleString()

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        found = fitted_index(part)
        found.insert(0, area, part[area].iloc[0])
        return found

    return edges.groupBy(area).applyInPandas(solve, f"`{area}` {kind}, {INDEX}")
