"""Codes and descriptions cut out of category texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_token(text: Column) -> Column:
    """Text before the first blank; the whole text if there is none."""
    return F.substring_index(text, " ", 1)


def bracket_code(text: Column) -> Column:
    """Text in the first pair of round brackets; empty if there is none."""
    return F.regexp_extract(text, r"\(([^)]+)\)", 1)


def class_code(text: Column) -> Column:
    """``01 ONE FAMILY`` -> ``01``."""
    return F.substring(text, 1, 2)


def class_description(text: Column) -> Column:
    """``01 ONE FAMILY`` -> ``ONE FAMILY``."""
    return F.trim(F.substr(text, F.lit(3)))
