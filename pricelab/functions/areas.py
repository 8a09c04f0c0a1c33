"""Five-digit zip codes from the forms in which feeds deliver them.

NULL stays NULL: ``format_string`` alone would print it as blanks or ``null``,
and such a text then passes any test for the zero code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelab.fixed_values import ZERO_ZIP


def zip_from_int(code: Column) -> Column:
    return F.when(code.isNotNull(), F.format_string("%05d", code.cast("long")))


def zip_from_double(code: Column) -> Column:
    return F.when(code.isNotNull(), F.format_string("%05.0f", code.cast("double")))


def zip_from_text(code: Column) -> Column:
    """First five digits, left-padded; ZIP+4 and ``21201.0`` both give ``21201``."""
    digits = F.regexp_extract(F.trim(code), r"^(\d{1,5})", 1)
    return F.when(digits != "", F.lpad(digits, 5, "0"))


def is_known_zip(zip_code: Column) -> Column:
    return zip_code.isNotNull() & (zip_code > F.lit(ZERO_ZIP))
