"""Overlap joins, uncertain dates, controls, survival, shapes and layouts, by brute force."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pricelab.operators import uncertain_dates
from pricelab.operators.controls import event_difference
from pricelab.operators.overlaps import overlap_join
from pricelab.operators.shapes import area_overlaps, nearest_perimeters
from pricelab.operators.survival import median_months, survival_curve, watched_months
from pricelab.operators.uncertain_dates import sales_with_chances, uncertain_impact
from pricelab.sinks.layout import NOWHERE, Box, Layout, read_box, write_layout

DAY = dt.date(2019, 1, 1)
RING = "array<struct<x double, y double>>"


def day(n):
    return DAY + dt.timedelta(n)


def month(i):
    return dt.date(2019 + (i - 1) // 12, (i - 1) % 12 + 1, 1)


def ring(vertices):
    return [{"x": float(x), "y": float(y)} for x, y in vertices]


def test_overlap_join_equals_all_pairs_at_every_size(spark):
    rng = random.Random(3)

    def rows(first):
        found = []
        for i in range(150):
            low, low2 = rng.uniform(-50, 50), rng.uniform(-50, 50)
            size, size2 = (rng.choice([0, 0.01, 1, 4, 16, 70, 300]) for _ in range(2))
            found.append((first + i, rng.choice(["a", "b"]), low, low + size, low2, low2 + size2))
        return found + [
            (first + 900, None, 0.0, 1.0, 0.0, 1.0), (first + 901, "a", None, 1.0, 0.0, 1.0),
            (first + 902, "a", 5.0, 1.0, 0.0, 1.0), (first + 903, "a", float("nan"), 1.0, 0.0, 1.0),
            (first + 904, "a", 0.0, float("inf"), 0.0, 1.0),
        ]

    left, right = rows(0), rows(1000)
    right.append((2000, left[0][1], left[0][3], left[0][3], left[0][5], left[0][5]))  # touches
    p = spark.createDataFrame(left, "p int, k string, a double, b double, c double, d double")
    q = spark.createDataFrame(right, "q int, k string, e double, f double, g double, h double")
    for n in (1, 2):
        found = overlap_join(
            p, q, ["k"],
            [(F.col("a"), F.col("b")), (F.col("c"), F.col("d"))][:n],
            [(F.col("e"), F.col("f")), (F.col("g"), F.col("h"))][:n], 0.5,
        )
        assert sorted(found.columns) == sorted([*p.columns, *set(q.columns) - {"k"}])
        got = [(r.p, r.q) for r in found.collect()]
        expected = {
            (x[0], y[0]) for x in left[:150] for y in right[:150] + right[-1:]
            if x[1] == y[1] and all(x[w] <= y[w + 1] and y[w] <= x[w + 1] for w in (2, 4)[:n])
        }
        assert len(got) == len(set(got)) and set(got) == expected
    args = (["k"], [(F.col("a"), F.col("b"))], [(F.col("e"), F.col("f"))])
    assert overlap_join(p.limit(0), q, *args).count() == 0 == overlap_join(p, q.limit(0), *args).count()
    with pytest.raises(ValueError, match="both sides: a"):
        overlap_join(p, p, *args)


def test_long_spans_are_listed_in_few_cells(spark):
    events = spark.createDataFrame([("a", 0, 1_000_000), ("a", 7, 7)], "k string, low long, high long")
    sales = spark.range(500).selectExpr("'a' AS k", "id AS at")
    found = overlap_join(sales, events, ["k"], [(F.col("at"), F.col("at"))], [(F.col("low"), F.col("high"))])
    assert found.count() == 501
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_chances_equal_a_count_of_days(spark):
    rng = random.Random(5)
    events = [("a", day(lo := rng.randint(0, 60)), day(lo + rng.choice([0, 1, 9, 40])), i) for i in range(12)]
    sales = [("a", day(lo := rng.randint(-30, 110)), day(lo + rng.choice([0, 5, 30])), 10.0 * i) for i in range(40)]
    s = spark.createDataFrame(sales, "zip_code string, first_day date, last_day date, price double")
    e = spark.createDataFrame(events, "zip_code string, earliest date, latest date, event int")
    got = {(r.event, r.price): (r.chance_before, r.chance_after) for r in sales_with_chances(s, e, 20).collect()}
    for _, a, b, event in events:
        for _, c, d, price in sales:
            apart = [x - t for t in range(a.toordinal(), b.toordinal() + 1)
                     for x in range(c.toordinal(), d.toordinal() + 1)]
            before = sum(-20 <= n <= -1 for n in apart) / len(apart)
            after = sum(0 <= n <= 19 for n in apart) / len(apart)
            assert got.get((event, price), (0, 0)) == pytest.approx((before, after))


def test_uncertain_events_keep_a_row_each(spark):
    sales = spark.createDataFrame(
        [("a", day(0), None, 100.0), ("a", day(10), day(10), 50.0), ("a", day(10), None, None),
         ("a", None, day(9), 1.0), ("a", day(9), day(2), 1.0), (None, day(5), None, 1.0)],
        "zip_code string, first_day date, last_day date, price double",
    )
    told = [("a", day(5), None, 1), ("a", day(5), None, 1), ("a", day(9), day(8), 2), ("b", day(5), day(6), 3),
            (None, None, None, None)]
    events = spark.createDataFrame(told, "zip_code string, earliest date, latest date, event int")
    got = {r.event: r for r in uncertain_impact(sales, events, ["event"], 10).collect()}
    assert set(got) == {1, 2, 3, None} and got[1].latest == day(5)
    assert tuple(got[1])[4:] == (2, 2, 1.0, 1.0, 100.0, 50.0)
    for event in (2, 3, None):
        assert tuple(got[event])[4:] == (0, 0, 0.0, 0.0, None, None)
    assert uncertain_impact(sales, events.limit(0), ["event"]).count() == 0


def test_equal_spans_meet_once(spark, monkeypatch):
    """Sales and events that share their spans of days are summed before they meet."""
    met, chances = [], uncertain_dates.sales_with_chances

    def counted(*args):
        met.append(chances(*args))
        return met[-1]

    monkeypatch.setattr(uncertain_dates, "sales_with_chances", counted)
    rng = random.Random(3)
    sold = [("a", day(lo := rng.randint(0, 5)), None if lo % 2 else day(lo + 3), 10.0 * i) for i in range(300)]
    told = [("a", day(4), day(6) if i % 2 else None, i) for i in range(40)] + [("a", day(4), day(4), 0)]
    sales = spark.createDataFrame(sold, "zip_code string, first_day date, last_day date, price double")
    events = spark.createDataFrame(told, "zip_code string, earliest date, latest date, event int")
    got = [tuple(r)[3:] for r in uncertain_dates.uncertain_impact(sales, events, ["event"], 3).collect()]
    assert met[0].count() <= 6 * 2
    each = {i: [(r.price, r.chance_before, r.chance_after) for r in chances(sales, events.where(f"event = {i}"), 3)
                .collect()] for i in (0, 1, 2)}
    for event, n, certain, before, after, price_before, price_after in got:
        if event not in each:
            continue
        rows = each[event]
        assert (n, certain) == (len(rows), sum(1.0 in r[1:] for r in rows))
        assert before == pytest.approx(sum(r[1] for r in rows)) and after == pytest.approx(sum(r[2] for r in rows))
        assert price_before == pytest.approx(sum(r[0] * r[1] for r in rows) / before)
        assert price_after == pytest.approx(sum(r[0] * r[2] for r in rows) / after)
    assert sorted(r[0] for r in got) == sorted([*range(40), 0])  # told twice: a row and the sales each time


def test_difference_takes_the_nearest_unaffected_area(spark):
    def around(area, before, after):
        return [(area, month(6), before), (area, month(7) + dt.timedelta(9), after)]

    rows = (
        around("a", 100.0, 60.0) + around("near", 110.0, 99.0) + around("tied", 90.0, 90.0)
        + around("tied2", 90.0, 45.0) + around("affected", 100.0, 1.0) + around("far", 500.0, 500.0)
        + [("half", month(6), 100.0), ("a", None, 5.0), (None, month(6), 100.0), ("a", month(6), float("nan"))]
    )
    sales = spark.createDataFrame(rows, "zip_code string, date date, price double")
    told = [("a", month(7)), ("a", month(7) + dt.timedelta(3)), ("affected", month(9)), ("nowhere", month(7)),
            ("", month(7)), (None, month(7)), ("a", None)]
    events = spark.createDataFrame(told, "zip_code string, event_month date")
    found = event_difference(sales, events, 3)
    got = {(r.zip_code, r.event_month): r for r in found.collect()}
    assert found.count() == 4 and set(got) == {
        ("a", month(7)), ("affected", month(9)), ("nowhere", month(7)), ("", month(7))}
    a = got[("a", month(7))]
    # 90 and 110 are equally near: the lower level, then the smaller code.
    assert (a.level_before, a.level_after, a.control, a.control_before, a.control_after) == (100, 60, "tied", 90, 90)
    assert a.effect == pytest.approx(-0.4)
    assert tuple(got[("nowhere", month(7))])[2:] == (None,) * 6
    # Sales of "affected" end before its month, so that nothing is known after it.
    assert got[("affected", month(9))].level_after is None and got[("affected", month(9))].effect is None
    assert event_difference(sales.limit(0), events, 3).count() == 4
    assert event_difference(sales, events.limit(0), 3).count() == 0


def test_difference_equals_all_pairs(spark):
    rng = random.Random(8)
    rows = [(f"z{rng.randint(0, 40):02}", month(rng.randint(1, 24)), float(rng.randint(50, 150))) for _ in range(900)]
    events = {(f"z{rng.randint(0, 20):02}", month(rng.randint(4, 20))) for _ in range(25)}
    got = {(r.zip_code, r.event_month): r for r in event_difference(
        spark.createDataFrame(rows, "zip_code string, date date, price double"),
        spark.createDataFrame(list(events), "zip_code string, event_month date"), 3).collect()}
    index = {month(i): i for i in range(1, 40)}

    def level(area, first, last):
        prices = [p for z, m, p in rows if z == area and first <= index[m] <= last]
        return sum(prices) / len(prices) if prices else None

    for area, at in events:
        i = index[at]
        own, best = level(area, i - 3, i - 1), None
        for other in {z for z, _, _ in rows}:
            if any(z == other and i - 3 <= index[m] <= i + 2 for z, m in events):
                continue
            if (b := level(other, i - 3, i - 1)) and level(other, i, i + 2) is not None and own is not None:
                best = min(best or (math.inf,), (abs(b - own), b, other))
        assert got[(area, at)].control == (best[2] if best else None)
    assert len(got) == len(events)


def test_difference_sorts_levels_and_looks_back_only(spark):
    """Few levels, so that many areas share one; also zero and negative ones, and those without an after."""
    rng = random.Random(5)
    before = {f"z{i:03}": float(rng.choice([-20, 0, 10, 20, 30, 40])) for i in range(90)}
    after = {z: float(rng.randint(1, 9)) for z in before if rng.random() < 0.8}
    rows = [(z, month(6), p) for z, p in before.items()] + [(z, month(7), p) for z, p in after.items()]
    told = {z for z in before if rng.random() < 0.4}
    early = {z for z in before if rng.random() < 0.1}  # an event in the month before affects them too
    found = event_difference(
        spark.createDataFrame(rows, "zip_code string, date date, price double"),
        spark.createDataFrame([(z, month(m)) for m, some in ((7, told), (6, early)) for z in some],
                              "zip_code string, event_month date"), 1)
    # Spark reads a frame that ends with the last row again for every row.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "unboundedfollowing" not in plan.lower() and "Cartesian" not in plan
    got = {r.zip_code: r for r in found.collect() if r.event_month == month(7)}
    free = [z for z, p in before.items() if p > 0 and z in after and z not in told | early]
    assert set(got) == told and len(free) > 20
    for z, r in got.items():
        best = min(free, key=lambda c: (abs(before[c] - before[z]), before[c], c))
        assert (r.level_before, r.level_after) == (before[z], after.get(z))
        assert (r.control, r.control_before, r.control_after) == (best, before[best], after[best])


def test_survival_by_hand(spark):
    # 6 watched: one recovers in month 1, one leaves in 2, two recover in 3, one leaves in 3, one recovers in 5.
    rows = [("a", 1, True), ("a", 2, False), ("a", 3, True), ("a", 3, True), ("a", 3, None), ("a", 5, True),
            (None, 4, False), ("b", None, True)]
    watched = spark.createDataFrame(rows, "area string, months int, recovered boolean")
    curve = survival_curve(watched, ["area"])
    got = {(r.area, r.month): tuple(r)[2:] for r in curve.collect()}
    s1, s3 = 5 / 6, 5 / 6 * 2 / 4
    assert set(got) == {("a", 1), ("a", 2), ("a", 3), ("a", 5), (None, 4)}
    assert got[("a", 1)] == pytest.approx((6, 1, 0, s1, s1 * s1 / 30))
    assert got[("a", 2)] == pytest.approx((5, 0, 1, s1, s1 * s1 / 30))
    assert got[("a", 3)] == pytest.approx((4, 2, 1, s3, s3 * s3 * (1 / 30 + 2 / 8)))
    assert got[("a", 5)] == (1, 1, 0, 0.0, None) and got[(None, 4)][3] == 1.0
    assert {tuple(r) for r in median_months(curve, ["area"]).collect()} == {("a", 3), (None, None)}
    assert [r.n_at_risk for r in survival_curve(watched).orderBy("month").collect()] == [7, 6, 5, 2, 1]
    assert survival_curve(watched.limit(0), ["area"]).count() == 0


def test_events_are_watched_until_recovery_or_the_last_month(spark):
    rows = [("a", month(3), 1.0, month(5), 2), ("a", month(4), 1.0, None, None), ("a", month(9), 1.0, None, None),
            ("a", month(2), None, None, None), ("b", month(2), 1.0, None, None)]
    found = spark.createDataFrame(
        rows, "zip_code string, event_month date, baseline double, recovered date, n_months int")
    monthly = spark.createDataFrame([("a", month(9)), ("a", month(1))], "zip_code string, date date")
    got = {(r.event_month, r.months, r.recovered) for r in watched_months(found, monthly).collect()}
    assert got == {(month(3), 2, True), (month(4), 5, False)}


def convex(rng, size):
    cx, cy = rng.uniform(-5, 5), rng.uniform(-5, 5)
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 7)))
    vertices = [(cx + size * math.cos(t), cy + size * 0.7 * math.sin(t)) for t in turns]
    return vertices if rng.random() < 0.5 else vertices[::-1]


def heights(vertices, x):
    ys = [y1 + (x - x1) * (y2 - y1) / (x2 - x1)
          for (x1, y1), (x2, y2) in zip(vertices, vertices[1:] + vertices[:1]) if (x1 > x) != (x2 > x)]
    return (min(ys), max(ys)) if ys else (0.0, 0.0)


def covered(one, other, steps=2000):
    """The area of two convex rings' common part, by slices."""
    x0, x1 = min(x for x, _ in one), max(x for x, _ in one)
    step = (x1 - x0) / steps
    total = 0.0
    for i in range(steps):
        x = x0 + (i + 0.5) * step
        (a, b), (c, d) = heights(one, x), heights(other, x)
        total += max(0.0, min(b, d) - max(a, c)) * step
    return total


def test_area_overlaps_equal_slices(spark):
    rng = random.Random(11)
    areas = {i: convex(rng, rng.choice([0.5, 2, 6])) for i in range(12)}
    rings = {i: convex(rng, rng.choice([0.5, 2, 6])) for i in range(12)}
    odd = [(90, []), (91, ring([(0, 0), (1, 1)])), (92, ring([(0, 0), (1, 1), (2, 2)])), (93, None),
           (94, [{"x": None, "y": 1.0}, *ring([(0, 0), (1, 0)])])]
    a = spark.createDataFrame([*((i, ring(v)) for i, v in areas.items()), *odd], f"area int, area_ring {RING}")
    p = spark.createDataFrame([*((i, ring(v)) for i, v in rings.items()), *odd], f"p int, ring {RING}")
    found = area_overlaps(a, p)
    assert set(found.columns) == {"area", "area_ring", "p", "ring", "share"}
    got = {(r.area, r.p): r.share for r in found.collect()}
    assert found.count() == len(got)
    for i, one in areas.items():
        whole = covered(one, one)
        for j, other in rings.items():
            assert got.pop((i, j), 0.0) == pytest.approx(covered(one, other) / whole, abs=3e-3)
    assert not got
    # An area with a dent: a comb of two teeth, cut by a box through both.
    comb = ring([(0, 0), (3, 0), (3, 2), (2, 2), (2, 1), (1, 1), (1, 2), (0, 2)])
    a = spark.createDataFrame([(1, comb)], f"area int, area_ring {RING}")
    p = spark.createDataFrame([(1, ring([(0, 1), (3, 1), (3, 2), (0, 2)])), (2, ring([(3, 0), (4, 0), (4, 2)]))],
                              f"p int, ring {RING}")
    assert [(r.p, r.share) for r in area_overlaps(a, p).collect()] == [(1, pytest.approx(2 / 5))]


def test_each_pair_is_clipped_once(spark):
    rng = random.Random(8)
    shapes = [(i, ring(convex(rng, 3))) for i in range(40)]
    a = spark.createDataFrame(shapes, f"area int, area_ring {RING}")
    p = spark.createDataFrame(shapes, f"p int, ring {RING}")
    found = area_overlaps(a, p).select("area", "p", F.round("share", 6).alias("share"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    after_join = plan[: plan.index("Join")]
    assert after_join.count("ArrowEvalPython") == 1
    assert "lambdafunction" not in after_join
    # Boxes side by side touch and do not overlap.
    step = [(i, ring([(i / 10, 0), ((i + 1) / 10, 0), ((i + 1) / 10, 1), (i / 10, 1)])) for i in range(20)]
    a = spark.createDataFrame(step, f"area int, area_ring {RING}")
    p = spark.createDataFrame(step, f"p int, ring {RING}")
    assert {(r.area, r.p, round(r.share, 9)) for r in area_overlaps(a, p).collect()} == {(i, i, 1.0) for i in range(20)}


def gap(x, y, vertices):
    best = math.inf
    for (ax, ay), (bx, by) in zip(vertices, vertices[1:] + vertices[:1]):
        long = (bx - ax) ** 2 + (by - ay) ** 2
        t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / long)) if long else 0
        best = min(best, math.hypot(ax + t * (bx - ax) - x, ay + t * (by - ay) - y))
    return best


def test_nearest_perimeters_equal_all_pairs(spark):
    rng = random.Random(13)
    rings = {i: convex(rng, rng.choice([0.01, 0.3, 2])) for i in range(15)}
    rings[50], rings[51] = [(7.0, 7.0)], [(8.0, -7.0), (9.0, -7.0)]  # a place, a line
    rings[60] = rings[51]  # equally near
    places = {i: (rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(300)}
    odd = [(900, None, 1.0), (901, float("nan"), 1.0), (None, 0.0, 0.0)]
    p = spark.createDataFrame([*((i, *at) for i, at in places.items()), *odd], "id int, x double, y double")
    p = p.unionByName(p.where("id = 1"))
    r = spark.createDataFrame(
        [*((i, ring(v)) for i, v in rings.items()), (70, []), (71, None), (72, [{"x": None, "y": 0.0}])],
        f"name int, ring {RING}")
    for doublings in (4, 0):
        rows = nearest_perimeters(p, r, "id", "name", 2.0, doublings).collect()
        got = {row.id: (row.distance, row.name) for row in rows}
        assert len(rows) == len(got)
        for i, (x, y) in places.items():
            def away(v):
                low, high = heights(v, x) if len(v) > 2 else (0, 0)
                return 0.0 if low < y < high else gap(x, y, v)
            best = min((away(v), name) for name, v in rings.items())
            if best[0] <= 2.0:
                assert got.pop(i) == (pytest.approx(best[0], abs=1e-12), best[1])
        assert not got
    assert nearest_perimeters(p, r.limit(0), "id", "name", 2.0).count() == 0
    assert nearest_perimeters(p.limit(0), r, "id", "name", 2.0).count() == 0


LAYOUT = Layout("x", "y", "day", (0.0, 1.0), (0.0, 1.0), (DAY, day(365)), bits=8, tile_bits=2)


def files_read(spark, df):
    """Files that the scan of ``df`` opens."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numFiles").value()


def test_a_box_reads_few_files_and_all_its_rows(spark, tmp_path):
    rng = random.Random(17)
    rows = [(i, rng.uniform(-0.1, 1.1), rng.uniform(0, 1), day(rng.randint(-10, 380))) for i in range(4000)]
    rows += [(5000 + i, 0.3, 0.3, day(100)) for i in range(2000)]  # a third in one cell
    rows += [(8000, None, 0.3, day(1)), (8001, float("nan"), 0.3, day(1)), (8002, 0.3, 0.3, None)]
    df = spark.createDataFrame(rows, "id int, x double, y double, day date")
    path = str(tmp_path / "laid")
    write_layout(df, LAYOUT, path, files=16)
    stored = spark.read.parquet(path)
    assert stored.count() == len(rows) and stored.where(f"tile = {NOWHERE}").count() == 3
    of_cell = stored.where("x = 0.3 AND y = 0.3 AND day IS NOT NULL").select(F.input_file_name()).distinct().count()
    assert of_cell > 1  # the hot cell is split
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = files_read(spark, stored)
        for box in [Box((0.1, 0.2), (0.6, 0.7), (day(30), day(60))), Box((-1, 0.0), (0, 1), (day(-50), day(400))),
                    Box((0.95, 2.0), (0.3, 0.4), (day(350), day(500)))]:
            found = read_box(spark, path, LAYOUT, box)
            got = {r.id for r in found.collect()}
            assert got and got == {
                i for i, x, y, d in rows if x is not None and d is not None
                and box.x[0] <= x <= box.x[1] and box.y[0] <= y <= box.y[1] and box.days[0] <= d <= box.days[1]}
            assert files_read(spark, found) < whole / 3
        none = read_box(spark, path, LAYOUT, Box((0.9, 0.1), (0, 1), (day(0), day(9))))
        assert none.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_keys_take_bits_in_turn(spark):
    layout = Layout("x", "y", "day", (0.0, 4.0), (0.0, 4.0), (DAY, day(4)), bits=2, tile_bits=1)
    rows = [(1.0, 0.0, day(0)), (0.0, 1.0, day(0)), (0.0, 0.0, day(1)), (3.5, 2.0, day(3)), (9.0, -9.0, day(0))]
    df = spark.createDataFrame(rows, "x double, y double, day date")
    assert [r[0] for r in df.select(layout.key()).collect()] == [1, 2, 4, 0b111101, 0b001001]
    assert layout.tiles(Box((0.0, 1.9), (2.0, 3.0), (DAY, day(3)))) == [2, 6]
    with pytest.raises(ValueError):
        Layout("x", "y", "day", (1.0, 1.0), (0.0, 1.0), (DAY, day(1)))
