"""Amounts and unit prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_amount(value: Column) -> Column:
    return value.try_cast("double")


def unit_price(price: Column, quantity: Column) -> Column:
    """Price per unit of area; NULL where the area is zero or unknown."""
    return F.try_divide(price, quantity)
