"""Sale facts: unpivot, floors, predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.fixed_values import HOUSING_DWELLINGS, HOUSING_STYLES, PRICE_FLOOR
from pricelab.schemas import SALE


def unpivot_sales(
    wide: DataFrame, pairs: Sequence[tuple[Column, Column]], keep: Sequence[str | Column] = ()
) -> DataFrame:
    """One row per (date, price) pair of a row, from a single scan."""
    sales = F.array(*[F.struct(d.alias("date"), p.alias("price")) for d, p in pairs])
    return wide.select(*keep, F.inline(sales))


def market_sales(sales: DataFrame, floor: float = PRICE_FLOOR) -> DataFrame:
    """Sales with a date and a price of at least ``floor``."""
    return sales.where((F.col("price") >= floor) & F.col("date").isNotNull())


def is_housing(type1: Column, type2: Column) -> Column:
    """Both structure types say housing; a missing type does not."""
    return type1.isin(HOUSING_STYLES) & type2.isin(HOUSING_DWELLINGS)


def as_sales(df: DataFrame) -> DataFrame:
    """The sale record, with NULL for the columns ``df`` does not have."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SALE.fields
        ]
    )


def per_unit(sales: DataFrame) -> DataFrame:
    """Prices per dwelling unit, for areas where whole buildings are sold."""
    return sales.withColumn("price", F.try_divide("price", "units")).withColumn(
        "price_sf", F.try_divide("price_sf", "units")
    )
