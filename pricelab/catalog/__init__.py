"""The operators as named queries over the given tables, with SQL to check them.

A query takes the session and a folder of Parquet tables. Areas, months, prices
and categories are played by the columns of those tables: a nation or brand is an
area, an order or line item a sale, its quantity the square feet.
"""

from pricelab.catalog import deliveries, files, impact, medians, places, rows, studies, tables  # noqa: F401
from pricelab.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
