"""Dates from the texts and numbers in which feeds deliver them; unreadable -> NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(moment: Column) -> Column:
    return F.trunc(moment, "MM")


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` or ``yyyy-MM``, the latter as the first of the month."""
    return F.try_to_date(text)


def dotted_date(text: Column) -> Column:
    """``yyyy.MM.dd``; the empty date ``0000.00.00`` gives NULL."""
    return iso_date(F.replace(text, F.lit("."), F.lit("-")))


def yyyymm_date(number: Column) -> Column:
    """``201905`` -> 2019-05-01."""
    digits = number.cast("string")
    return iso_date(F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2)))
