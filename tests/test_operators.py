import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from pricelab import fixed_values as V
from pricelab.operators.dictionary import category_dictionary, description_lists
from pricelab.operators.impact import event_impact, recovery_months
from pricelab.operators.perimeters import inside_edges, points_in_perimeters, ring_edges
from pricelab.operators.sales import as_sales, is_housing, market_sales, per_unit, unpivot_sales
from pricelab.operators.segments import (
    appended_medians,
    ledger_segments,
    repeated_keys,
    segment_medians,
)
from pricelab.operators.unify import as_series, union_sources
from pricelab.plans import feeds
from pricelab.schemas import LEDGER_SHEET, SALE, UNIFIED_SERIES

MAY, JUNE = dt.date(2019, 5, 1), dt.date(2019, 6, 1)


def test_unpivot_is_one_scan_without_shuffle(spark):
    wide = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    day = F.col("o_orderdate").cast("date")
    pairs = [(day, F.col("o_totalprice")), (F.date_add(day, 9), F.col("o_totalprice") * 2)]
    long = unpivot_sales(wide, pairs, ["o_orderkey"])
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert long.count() == 2 * wide.count()


def test_price_floor_edges(spark):
    rows = [(1999.99, MAY), (2000.0, MAY), (3000.0, None), (None, MAY)]
    kept = market_sales(spark.createDataFrame(rows, "price double, date date")).collect()
    assert [r.price for r in kept] == [2000.0]


def test_housing_needs_both_types(spark):
    rows = [("STRY", "DWEL"), ("DWEL", "STRY"), (None, "DWEL"), ("OTHER", None), ("HOUSING", "OTHER")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [tuple(r) for r in df.where(is_housing(F.col("a"), F.col("b"))).collect()] == [
        ("STRY", "DWEL"), ("HOUSING", "OTHER"),
    ]


def test_per_unit_prices(spark):
    df = spark.createDataFrame([(6000.0, 6.0, 3.0), (6000.0, 6.0, 0.0)], "price double, price_sf double, units double")
    assert [(r.price, r.price_sf) for r in per_unit(df).collect()] == [(2000.0, 2.0), (None, None)]


def test_sale_record_fills_missing_columns(spark):
    got = as_sales(spark.createDataFrame([("21201", 5)], "zip_code string, price int"))
    assert got.schema.fieldNames() == SALE.fieldNames()
    assert got.first().price == 5.0 and got.first().type1 is None


def sales_frame(spark, rows):
    return spark.createDataFrame(rows, "zip_code string, date date, price double, price_sf double, code string")


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_one_pass_equals_a_query_per_segment(spark, seed):
    rng = random.Random(seed)
    codes = V.ALL_HOMES_CODES + ["21", "99", None]
    rows = [
        ("1030%d" % rng.randint(0, 2), MAY, float(rng.randint(1, 50)), rng.choice([None, 1.5, 2.5]), rng.choice(codes))
        for _ in range(150)
    ]
    sales = sales_frame(spark, rows)
    segments = ledger_segments(F.col("code"))
    got = {(r.zip_code, r.segment, r.measure): r.price for r in segment_medians(sales, segments).collect()}
    expected = {}
    chosen = {V.ALL_HOMES: V.ALL_HOMES_CODES, V.CONDOS: V.CONDO_CODES, V.SINGLE_FAMILY: ["01"]}
    for segment, members in chosen.items():
        for place, measure in ((2, "price"), (3, "price_sf")):
            groups = {}
            for row in rows:
                if row[4] in members and row[place] is not None:
                    groups.setdefault(row[0], []).append(row[place])
            for zip_code, values in groups.items():
                expected[(zip_code, segment, measure)] = sorted(values)[(len(values) - 1) // 2]
    assert got == expected
    approx = segment_medians(sales, segments, method="approx", accuracy=10_000)
    assert {(r.zip_code, r.segment, r.measure): r.price for r in approx.collect()} == expected


def test_segments_need_one_shuffle(spark):
    sales = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        F.col("l_returnflag").alias("zip_code"),
        F.trunc("l_shipdate", "MM").alias("date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("price_sf"),
        F.col("l_linestatus").alias("code"),
        F.col("l_tax"),
    )
    got = segment_medians(sales, {"O": F.col("code") == "O", "F": F.col("code") == "F"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
    assert "l_tax" not in plan


def test_append_gives_a_row_per_region(spark):
    rows = [("10301", MAY, 1.0, "a"), ("10301", MAY, 3.0, "b"), ("10302", MAY, 5.0, "a")]
    sales = spark.createDataFrame(rows, "zip_code string, date date, price double, region string")
    found = repeated_keys(appended_medians(sales, "region")).collect()
    assert [tuple(r) for r in found] == [("10301", MAY, 2, 1.0, 3.0)]


def test_dictionary(spark):
    rows = [("02", "TWO"), ("01", "B"), ("01", "A"), ("01", "A"), (None, "X")]
    df = spark.createDataFrame(rows, "c string, d string")
    got = [tuple(r) for r in category_dictionary(df, F.col("c"), F.col("d")).collect()]
    assert got == [(None, "X"), ("01", "A"), ("01", "B"), ("02", "TWO")]
    lists = description_lists(category_dictionary(df, F.col("c"), F.col("d")), 1).collect()
    assert {tuple(r) for r in map(lambda r: (r[0], *r[1], r[2]), lists)} == {
        (None, "X", 1), ("01", "A", 2), ("02", "TWO", 1),
    }
    assert category_dictionary(df, F.col("c"), F.col("d"), limit=1).count() == 1


def test_unified_dates_are_months(spark):
    one = spark.createDataFrame([("1", dt.date(2019, 5, 31), 2)], "zip_code string, date date, price int")
    got = union_sources([as_series(one, source="a", segment="s", measure="m")] * 2)
    assert got.schema.fieldNames() == UNIFIED_SERIES.fieldNames()
    assert [tuple(r) for r in got.collect()] == [("a", "s", "m", "1", MAY, 2.0)] * 2


def month(i):
    return dt.date(2019 + (i - 1) // 12, (i - 1) % 12 + 1, 1)


def test_impact_and_recovery(spark):
    # Price 100 before the event in month 7, 60 after it, back to 110 in month 12.
    prices = {i: 100.0 if i < 7 else 60.0 if i < 12 else 110.0 for i in range(1, 20)}
    rows = [("a", month(i), p) for i, p in prices.items()]
    rows += [("b", month(i), 100.0 if i < 7 else 50.0) for i in range(1, 20)]
    sales = spark.createDataFrame(rows, "zip_code string, date date, price double")
    # The event of "a" is told twice, in the middle of the month; "c" has no sales.
    told = [("a", month(7) + dt.timedelta(14), 1), ("a", month(7), 2), ("b", month(7), 3), ("c", month(7), 4)]
    events = spark.createDataFrame(told, "zip_code string, event_month date, id int")
    got = {r.zip_code: r for r in event_impact(sales, events, 3).collect()}
    assert event_impact(sales, events, 3).count() == 3 and set(got) == {"a", "b", "c"}
    assert (got["c"].price_before, got["c"].price_after, got["c"].change) == (None, None, None)
    assert (got["a"].price_before, got["a"].price_after) == (100.0, 60.0)
    assert abs(got["b"].change + 0.5) < 1e-12
    back = {r.zip_code: r.n_months for r in recovery_months(sales, sales, events, 6).collect()}
    assert back == {"a": 5, "b": None, "c": None}


def even_odd(x, y, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            inside = not inside
    return inside


def test_perimeters_equal_brute_force(spark):
    rng = random.Random(1)
    points = [(i, rng.uniform(-20, 20), rng.uniform(-20, 20)) for i in range(400)]
    rings = {"line": [(0.0, 0.0), (1.0, 1.0)], "none": []}
    for j in range(12):
        size = rng.choice([0.5, 3, 9, 40])
        cx, cy = rng.uniform(-20, 20), rng.uniform(-20, 20)
        rings[f"r{j}"] = [
            (cx + rng.uniform(-size, size), cy + rng.uniform(-size, size)) for _ in range(rng.randint(3, 9))
        ]
    p = spark.createDataFrame(points, "id int, x double, y double")
    r = spark.createDataFrame(
        [(n, [{"x": x, "y": y} for x, y in ring]) for n, ring in rings.items()],
        "name string, ring array<struct<x double, y double>>",
    )
    expected = {(i, n) for i, x, y in points for n, ring in rings.items() if len(ring) > 2 and even_odd(x, y, ring)}
    for limit in (500_000, 0):
        found = points_in_perimeters(p, r, broadcast_vertices=limit)
        assert found.columns == ["id", "x", "y", "name"]
        got = [(row["id"], row["name"]) for row in found.collect()]
        assert len(got) == len(set(got)) and set(got) == expected
    assert points_in_perimeters(p, r.limit(0)).count() == 0
    inside = inside_edges(F.lit(0.5), F.lit(0.5), ring_edges(F.col("ring")))
    assert r.where("name IN ('none', 'line')").where(inside).count() == 0


def test_single_family_total_is_a_price_not_a_unit_price(spark):
    rows = [("01 ONE FAMILY", 10301.0, 1.0, 1000.0, 5000.0, dt.date(2019, 5, 9)),
            ("01 ONE FAMILY", None, 1.0, 1000.0, 5000.0, dt.date(2019, 5, 9)),
            ("01 ONE FAMILY", 0.0, 1.0, 1000.0, 5000.0, dt.date(2019, 5, 9)),
            ("01 ONE FAMILY", 10301.0, 1.0, 0.0, 1999.0, dt.date(2019, 5, 9))]
    series = feeds.ledger_series(feeds.ledger_sales(spark.createDataFrame(rows, LEDGER_SHEET)))
    got = {(r.segment, r.measure): (r.zip_code, r.date, r.price) for r in series.collect()}
    assert got == {
        ("allHomes", "price"): ("10301", MAY, 5000.0),
        ("allHomes", "price_sf"): ("10301", MAY, 5.0),
        ("sfHomes", "price"): ("10301", MAY, 5000.0),
        ("sfHomes", "price_sf"): ("10301", MAY, 5.0),
    }


def test_assessor_feed(spark):
    names = [V.ASSESSOR_ZIP, V.ASSESSOR_DATE_1, V.ASSESSOR_PRICE_1, V.ASSESSOR_DATE_2, V.ASSESSOR_PRICE_2,
             V.ASSESSOR_DATE_3, V.ASSESSOR_PRICE_3, V.ASSESSOR_SQUARE_FEET, V.ASSESSOR_STYLE, V.ASSESSOR_DWELLING]
    rows = [("21201-9", "2019.05.31", "4000", "2019.06.02", "5000", "0000.00.00", "6000", "2", "STRY 1 (01)", "DWEL (0001)"),
            ("501", "2019.05.01", "1999", "", None, None, None, "0", "STRY", "DWEL"),
            ("", "2019.05.01", "9999", "", None, None, None, "1", "STRY", "DWEL"),
            ("21201", "2019.05.01", "9999", "", None, None, None, "1", "SHOP", "DWEL")]
    roll = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    sales = sorted(tuple(r)[:4] + (r.type1, r.code1, r.code2) for r in feeds.assessor_sales(roll).collect())
    assert sales == [
        ("21201", MAY, 4000.0, 2000.0, "STRY", "01", "0001"),
        ("21201", JUNE, 5000.0, 2500.0, "STRY", "01", "0001"),
    ]
    series = feeds.assessor_series(feeds.assessor_sales(roll)).collect()
    assert {(r.source, r.measure, r.date, r.price) for r in series} == {
        ("MD", "price", MAY, 4000.0), ("MD", "price_sf", MAY, 2000.0),
        ("MD", "price", JUNE, 5000.0), ("MD", "price_sf", JUNE, 2500.0),
    }


def test_provider_metrics_get_labels(spark):
    pairs = spark.createDataFrame(
        [("MSPFCO", "10301", MAY, 1.0), ("MSPAH", "10301", MAY, None), ("OTHER", "1", MAY, 1.0)],
        "metric string, zip_code string, date date, price double",
    )
    with pytest.raises(Exception, match="unknown metric: OTHER"):
        feeds.provider_series(pairs).collect()
    got = {(r.segment, r.measure, r.price) for r in feeds.provider_series(pairs, others="drop").collect()}
    assert got == {("condos", "price_sf", 1.0), ("allHomes", "price", None)}


def test_views_serve_sql(spark):
    feeds.register_views({"pricelab_test_view": spark.range(3)})
    assert spark.sql("SELECT count(*) AS n FROM pricelab_test_view").first().n == 3
