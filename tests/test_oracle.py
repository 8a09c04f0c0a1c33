"""Every registered query against its SQL in DuckDB, over whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from pricelab import catalog

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def kind(name: str) -> str:
    name = name.lower()
    for group, members in {
        "text": ("string", "varchar"),
        "whole": ("int", "bigint", "long", "hugeint", "integer"),
        "real": ("double", "float"),
        "date": ("date",),
        "bool": ("boolean",),
    }.items():
        if name in members:
            return group
    return name


def normal(rows, order):
    def cell(v):
        if v is None:
            return ""
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.9g}"
        return str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, oracle, name):
    got = entry_module.queries()[name](spark, SF_DIR)
    want = oracle.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in want.description]
    types = {d[0]: kind(str(d[1])) for d in want.description}
    assert sorted(got.columns) == sorted(names)
    assert {f.name: kind(f.dataType.simpleString()) for f in got.schema.fields} == types
    order = sorted(names)
    expected = normal(want.fetchall(), [names.index(n) for n in order])
    actual = normal([tuple(r) for r in got.collect()], [got.columns.index(n) for n in order])
    assert len(actual) == len(expected)
    assert len(actual) > 0
    assert actual == expected


def test_every_query_of_the_catalogue_has_sql():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    got = entry_module.entry(spark)
    assert got.columns == ["zip_code", "date", "price"]
    assert got.count() > 0
