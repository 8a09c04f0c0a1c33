import math
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricelab.operators import medians as M

KEYS = ["area", "month"]


def lower_median(values):
    kept = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return kept[(len(kept) + 1) // 2 - 1] if kept else None


def make_rows(seed=7, n=4000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # "hot" takes a third of the rows, "same" holds one value only.
        area = rng.choice(["hot", "hot", "b", "c", "same", None])
        price = 5.0 if area == "same" else round(rng.lognormvariate(12, 1.5), 2)
        if rng.random() < 0.05:
            price = None
        if rng.random() < 0.01:
            price = rng.choice([float("nan"), float("inf"), -1.0, 0.0])
        rows.append((area, i % 2, price, rng.choice([0.0, 1.0, 7.0, None])))
    rows += [("empty", 0, None, None)] * 300
    return rows


def brute_force(rows):
    groups = defaultdict(lambda: ([], []))
    for area, month, price, size in rows:
        all_prices, unit = groups[(area, month)]
        all_prices.append(price)
        if size and price is not None:
            unit.append(price / size)
    return {k: (lower_median(a), lower_median(u)) for k, (a, u) in groups.items()}


def measures():
    return [
        M.Measure("total", F.col("price")),
        M.Measure("unit", F.try_divide("price", "size"), F.col("size").isNotNull()),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "area string, month int, price double, size double")


def as_dict(df):
    out = {(r.area, r.month): (r.total, r.unit) for r in df.collect()}
    return out


@pytest.mark.parametrize(
    "hot_rows, broadcast_rows, staged",
    [
        (100_000, 10_000, False),
        (100_000, 10_000, True),
        (50, 10_000, True),
        (1, 10_000, False),
        (400, 0, False),
    ],
)
def test_exact_equals_brute_force_on_every_path(spark, hot_rows, broadcast_rows, staged):
    rows = make_rows()
    df = frame(spark, rows).repartition(5)
    got = M.exact_medians(
        df, KEYS, measures(), hot_rows=hot_rows, broadcast_rows=broadcast_rows, staged=staged
    )
    assert got.columns == ["area", "month", "total", "unit"]
    assert as_dict(got) == brute_force(rows)


def passes(monkeypatch, spark, values):
    """How often rows are counted against ranges, and the median."""
    counted = []
    real = M.small_side
    monkeypatch.setattr(M, "small_side", lambda *a: counted.append(a) or real(*a))
    rows = [("x", 0, v, 1.0) for v in values]
    got = M.exact_medians(frame(spark, rows), KEYS, [measures()[0]], hot_rows=5).first().total
    monkeypatch.undo()
    assert got == lower_median(values)
    return len(counted)


def test_passes_do_not_depend_on_the_values(spark, monkeypatch):
    uniform = [float(i) for i in range(2000)]
    tails = [math.exp(math.exp(random.Random(i).gauss(0, 1.5))) for i in range(2000)]
    powers = [float(10**e) for e in range(0, 300)] * 3 + [1e308, -1e308, float("inf"), float("-inf")]
    same = [7.0] * 500
    assert {passes(monkeypatch, spark, v) for v in (uniform, tails, powers, same)} == {1}


def test_no_value_is_left_out(spark):
    inf, nan = float("inf"), float("nan")
    for values in ([1.0, inf, inf], [-inf, -inf, 1.0], [1.0, nan, nan], [1.7e308, 1.7e308, -1.0]):
        df = frame(spark, [("x", 0, v, 1.0) for v in values])
        for hot_rows in (100, 1):
            got = M.exact_medians(df, KEYS, [measures()[0]], hot_rows=hot_rows).first().total
            assert str(got) == str(lower_median(values))
            left = [M.Measure("total", F.col("price"), without_nan=True)]
            got = M.exact_medians(df, KEYS, left, hot_rows=hot_rows).first().total
            assert got == lower_median([v for v in values if not math.isnan(v)])


def test_types_are_kept(spark):
    large = 9007199254740993
    for kind, values in {
        "bigint": [large - 2, large, large + 2, None],
        "decimal(38,3)": [Decimal("12345678901234567890.001"), Decimal("1e3"), Decimal("9e30")],
        "int": [3, 1, 2, 9],
    }.items():
        df = spark.createDataFrame([("x", v) for v in values * 9], f"area string, v {kind}")
        want = sorted(v for v in values * 9 if v is not None)
        for hot_rows in (100, 1):
            got = M.exact_medians(df, ["area"], [M.Measure("m", F.col("v"))], hot_rows=hot_rows)
            assert got.schema["m"].dataType == df.schema["v"].dataType
            assert got.first().m == want[(len(want) - 1) // 2]


def test_a_range_that_misses_the_rank_is_opened(spark, monkeypatch):
    monkeypatch.setattr(M, "SKETCH_ACCURACY", -20)  # ends swapped: the rank lies outside
    rows = [("x", 0, float(v), 1.0) for v in range(400)] + [("y", 0, float(v * v), 1.0) for v in range(99)]
    real = F.expr
    monkeypatch.setattr(M.F, "expr", lambda text: real(text.replace(", -20)", ", 20)")))
    got = M.exact_medians(frame(spark, rows), KEYS, [measures()[0]], hot_rows=5)
    assert {r.area: r.total for r in got.collect()} == {"x": 199.0, "y": 49.0**2}


def test_even_group_gives_the_lower_value(spark):
    rows = [("x", 0, float(v), 1.0) for v in (4, 2, 1, 3)]
    for hot_rows in (100, 1):
        got = M.exact_medians(frame(spark, rows), KEYS, measures(), hot_rows=hot_rows)
        assert got.first().total == 2.0


def test_result_does_not_depend_on_partitioning(spark):
    df = frame(spark, make_rows(seed=3, n=1500))
    results = [
        as_dict(M.exact_medians(df.repartition(n), KEYS, measures(), hot_rows=100))
        for n in (1, 6)
    ]
    assert results[0] == results[1]


def test_approximate_rank_error_is_bounded(spark):
    rows = [("x", 0, float(v), 1.0) for v in range(20_000)]
    got = M.approx_medians(frame(spark, rows).repartition(6), KEYS, measures(), accuracy=100)
    assert abs(got.first().total - 9_999) <= 20_000 / 100 + 1


def test_approximate_is_exact_on_groups_up_to_half_the_accuracy(spark):
    rows = make_rows(n=2000)
    got = M.approx_medians(frame(spark, rows).repartition(7), KEYS, measures(), accuracy=10_000)
    assert as_dict(got) == brute_force(rows)


def test_small_groups_need_one_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumn("size", F.lit(2.0))
    got = M.exact_medians(
        df, ["o_orderpriority"], [M.Measure("m", F.col("o_totalprice") / F.col("size"))]
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "o_custkey" not in plan


@pytest.mark.parametrize("broadcast_rows, join", [(10_000, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_hot_groups_meet_their_rows_by_key(spark, broadcast_rows, join):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = M.exact_medians(
            frame(spark, make_rows(n=600)), KEYS, measures(), hot_rows=100, broadcast_rows=broadcast_rows
        )
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert join in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if broadcast_rows == 0:
        assert "BroadcastHashJoin" not in plan


def test_series_drops_null_medians(spark):
    wide = spark.createDataFrame([("x", 0, 1.0, None)], "area string, month int, total double, unit double")
    got = M.series(wide, KEYS, {"total": {"measure": "t"}, "unit": {"measure": "u"}})
    assert [tuple(r) for r in got.collect()] == [("x", 0, "t", 1.0)]


def test_wide_integers_keep_few_rows_between(spark, monkeypatch):
    counted = []
    write = M.stage

    def stage(df, label, *args):
        staged = write(df, label, *args)
        if label == "hot-counts":
            counted.append(staged.count())
        return staged

    monkeypatch.setattr(M, "stage", stage)
    df = spark.range(60_000).selectExpr("'a' AS area", "id * 7919 % 60000 + 4611686018427387904 AS v")
    got = M.exact_medians(df, ["area"], [M.Measure("m", F.col("v"))], hot_rows=100).first()
    assert got.m == 4611686018427387904 + 29_999
    assert len(counted) == 1 and counted[0] < 300


def test_measures_of_a_type_share_their_passes(spark, monkeypatch):
    labels = []
    write = M.stage
    monkeypatch.setattr(M, "stage", lambda df, label, *args: labels.append(label) or write(df, label, *args))
    df = spark.range(3_000).selectExpr("id % 2 AS area", "cast(id AS double) AS v", "id AS w")

    def staged(n):
        labels.clear()
        doubles = [M.Measure(f"v{i}", F.col("v") + i, F.col("w") % (i + 2) == 0) for i in range(n)]
        longs = [M.Measure(f"w{i}", F.col("w") + i) for i in range(n)]
        got = {r.area: r for r in M.exact_medians(df, ["area"], doubles + longs, hot_rows=100).collect()}
        for area in (0, 1):
            for i in range(n):
                values = [x for x in range(area, 3_000, 2) if x % (i + 2) == 0]
                want = float(values[(len(values) - 1) // 2] + i) if values else None
                assert got[area][f"v{i}"] == want
                assert got[area][f"w{i}"] == list(range(area, 3_000, 2))[(1_500 - 1) // 2] + i
        return len(labels)

    assert staged(1) == staged(4)
