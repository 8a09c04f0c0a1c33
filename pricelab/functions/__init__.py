"""Column functions. Each maps columns to a column and is safe in ANSI mode."""

from pricelab.functions.areas import is_known_zip, zip_from_double, zip_from_int, zip_from_text
from pricelab.functions.dates import dotted_date, iso_date, month_start, yyyymm_date
from pricelab.functions.money import to_amount, unit_price
from pricelab.functions.text import bracket_code, class_code, class_description, first_token

__all__ = [
    "bracket_code",
    "class_code",
    "class_description",
    "dotted_date",
    "first_token",
    "is_known_zip",
    "iso_date",
    "month_start",
    "to_amount",
    "unit_price",
    "yyyymm_date",
    "zip_from_double",
    "zip_from_int",
    "zip_from_text",
]
