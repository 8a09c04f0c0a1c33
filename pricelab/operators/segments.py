"""Medians per area, month, market segment and measure in one pass over the sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.fixed_values import (
    ALL_HOMES,
    ALL_HOMES_CODES,
    CONDO_CODES,
    CONDOS,
    PER_SQUARE_FOOT,
    SINGLE_FAMILY,
    SINGLE_FAMILY_CODES,
    TOTAL,
)
from pricelab.operators.medians import Measure, approx_medians, exact_medians, series

AREA_MONTH = ("zip_code", "date")


def ledger_segments(code: Column) -> dict[str, Column]:
    """The market segments of the sales ledger, by building class code."""
    return {
        ALL_HOMES: code.isin(ALL_HOMES_CODES),
        CONDOS: code.isin(CONDO_CODES),
        SINGLE_FAMILY: code.isin(SINGLE_FAMILY_CODES),
    }


def segment_medians(
    sales: DataFrame,
    segments: Mapping[str, Column | None],
    values: Sequence[str] = (TOTAL, PER_SQUARE_FOOT),
    *,
    keys: Sequence[str] = AREA_MONTH,
    method: str = "exact",
    accuracy: int = 100,
    **options,
) -> DataFrame:
    """Rows (keys, segment, measure, price). A row may belong to several segments.

    ``method`` is ``exact`` or ``approx``; ``options`` go to ``exact_medians``.
    """
    measures, labels = [], {}
    for segment, where in segments.items():
        for value in values:
            name = f"{segment}_{value}"
            measures.append(Measure(name, F.col(value), where))
            labels[name] = {"segment": segment, "measure": value}
    any_segment = _any(list(segments.values()))
    rows = sales if any_segment is None else sales.where(any_segment)
    if method == "exact":
        medians = exact_medians(rows, keys, measures, **options)
    elif method == "approx":
        medians = approx_medians(rows, keys, measures, accuracy)
    else:
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")
    return series(medians, keys, labels)


def _any(conditions: list[Column | None]) -> Column | None:
    """A row outside every segment need not be shuffled."""
    if any(c is None for c in conditions):
        return None
    either = conditions[0]
    for condition in conditions[1:]:
        either = either | condition
    return either


def appended_medians(
    sales: DataFrame, region: str, value: str = TOTAL, **options
) -> DataFrame:
    """Medians per region, appended: an area in two regions has two rows a month."""
    return segment_medians(
        sales, {ALL_HOMES: None}, [value], keys=[region, *AREA_MONTH], **options
    ).select(region, *AREA_MONTH, "price")


def repeated_keys(medians: DataFrame, keys: Sequence[str] = AREA_MONTH) -> DataFrame:
    """Keys with more than one row, with the number of rows and their price range."""
    return (
        medians.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .where(F.col("n_rows") > 1)
    )
