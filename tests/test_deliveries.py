"""Stored medians, keyed replacement, quarantine and repeated sales beyond their queries."""

import datetime as dt
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.operators.median_state import MedianStore
from pricelab.operators.medians import Measure
from pricelab.operators.repeat_sales import repeat_sales_index, sale_pairs
from pricelab.plans.staging import new_folder
from pricelab.sinks.upsert import MonthlyTable
from pricelab.sources.quarantine import read_csv_checked, read_json_checked

DAY = dt.date


def test_states_merge_within_their_bound(spark):
    draw = np.random.default_rng(1)
    values = defaultdict(list)
    store = MedianStore(new_folder(spark, "states"), ("zip_code",), ("price", "unit"))
    measures = [Measure("price", F.col("price")), Measure("unit", F.col("price"), F.col("price") > 900)]
    for delivery in range(5):
        rows = [
            ("hot" if draw.random() < 0.7 else f"z{draw.integers(4)}", float(draw.gamma(2, 200) + 300 * delivery))
            for _ in range(8000)
        ]
        for zip_code, price in rows:
            values[zip_code].append(price)
        odd = [(None, 5.0), ("empty", None), ("empty", float("nan"))]
        frame = spark.createDataFrame(rows + odd, "zip_code string, price double")
        store.deliver(frame, f"de/livery {delivery}=ü", measures)
        store.deliver(frame, f"de/livery {delivery}=ü", measures)  # again
    assert store.deliveries(spark).count() == 5
    for kept in (store, store.compacted(spark, new_folder(spark, "states"))):
        got = {r.zip_code: r for r in kept.medians(spark).collect()}
        assert set(got) == {*values, None, "empty"}
        assert (got["empty"].price, got["empty"].n_price) == (None, 0)
        assert (got[None].price, got[None].n_price) == (5.0, 5)
        for zip_code, found in values.items():
            for name, own in (("price", sorted(found)), ("unit", sorted(v for v in found if v > 900))):
                assert got[zip_code][f"n_{name}"] == len(own)
                rank = np.searchsorted(own, got[zip_code][name], side="right")
                assert abs(rank - len(own) / 2) <= max(1, 0.01 * len(own))


def test_a_delivery_reads_no_other(spark):
    store = MedianStore(new_folder(spark, "states"), ("zip_code",), ("price",))
    frame = spark.createDataFrame([("a", 1.0)], "zip_code string, price double")
    store.deliver(frame, "one", [Measure("price", F.col("price"))])
    files = set(spark.read.parquet(store.path).inputFiles())
    store.deliver(frame, "two", [Measure("price", F.col("price"))])
    assert files < set(spark.read.parquet(store.path).inputFiles())
    with pytest.raises(ValueError, match="price"):
        store.deliver(frame, "three", [Measure("other", F.col("price"))])


SERIES = "zip_code string, date date, price double, version int"


def test_upsert_replaces_by_key(spark):
    target = MonthlyTable(new_folder(spark, "monthly"))

    def upsert(*rows):
        return target.upsert(spark.createDataFrame(list(rows), SERIES))

    def rows():
        return Counter(map(tuple, target.read(spark).collect()))

    jan, feb, mar = (DAY(2020, m, 5) for m in (1, 2, 3))
    assert upsert(("a", jan, 1.0, 1), ("a", feb, 2.0, 1), (None, feb, 3.0, 1), ("a", None, 4.0, 1)) == 3
    once = rows()
    assert once.total() == 4
    upsert(("a", jan, 1.0, 1), ("a", feb, 2.0, 1), (None, feb, 3.0, 1), ("a", None, 4.0, 1))
    assert rows() == once
    before = {f: f for f in spark.read.parquet(target.path).inputFiles()}
    late = [("a", feb, 7.0, 2), ("b", feb, 8.0, 2), (None, feb, 1.0, 0), ("a", mar, 5.0, 2), ("a", mar, 6.0, 2)]
    assert upsert(*late) == 2
    want = Counter([("a", jan, 1.0, 1), ("a", feb, 7.0, 2), (None, feb, 3.0, 1), ("a", None, 4.0, 1),
                    ("b", feb, 8.0, 2), ("a", mar, 6.0, 2)])
    assert rows() == want
    assert upsert(*late) == 2 and rows() == want
    # Months that a delivery does not touch keep their very files.
    after = set(spark.read.parquet(target.path).inputFiles())
    assert {f for f in before if "m2020-01" in f or "none" in f} <= after
    assert upsert() == 0 and rows() == want
    with pytest.raises(ValueError, match="version"):
        target.upsert(spark.createDataFrame([("a", jan)], "zip_code string, date date"))


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType()),
                       T.StructField("note", T.StringType())])


def test_malformed_records_of_several_files(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"id": 1, "price": 2.5}\n{"id": 2, "price": \n\n{"id": "x"}\n[1, 2]\n')
    (tmp_path / "two.json").write_text('{"id": 3, "note": "ok", "more": 1}\n')
    checked = read_json_checked(spark, str(tmp_path / "*.json"), SCHEMA)
    assert sorted(map(tuple, checked.good.collect()), key=str) == [(1, 2.5, None), (3, None, "ok")]
    report = {r.file.rsplit("/", 1)[1]: (r.n_good, r.n_malformed) for r in checked.file_report().collect()}
    assert report == {"one.json": (1, 3), "two.json": (1, 0)}
    found = Counter((r.reason, r.record) for r in checked.malformed.collect())
    assert found == Counter([("not_json", '{"id": 2, "price": '), ("types", '{"id": "x"}'), ("types", "[1, 2]")])


def test_malformed_csv(spark, tmp_path):
    lines = ["id,price,note", "1,2.5,a", '2,3.5,"a, b"', "3,4.5", '4,5.5,"x, y",z', "5,much,c", '6,"x",d', "7,,"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    checked = read_csv_checked(spark, str(tmp_path), SCHEMA)
    assert {r.id: (r.price, r.note) for r in checked.good.collect()} == {
        1: (2.5, "a"), 2: (3.5, "a, b"), 7: (None, None),
    }
    got = {r.record: r.reason for r in checked.malformed.collect()}
    assert got == {lines[3]: "fields", lines[4]: "fields", lines[5]: "types", lines[6]: "types"}
    assert {(r.reason, r.n_rows) for r in checked.reasons().collect()} == {("fields", 2), ("types", 2)}


def test_repeat_sales_by_brute_force(spark):
    draw = np.random.default_rng(2)
    months = [DAY(2000 + i // 12, i % 12 + 1, 1) for i in range(30)]
    trend = {area: np.cumsum(draw.normal(0.01, 0.05, 30)) for area in "abc"}
    rows = []
    for home in range(900):
        area = "abc"[home % 3]
        worth = draw.normal(12, 0.5)
        for at in sorted(draw.choice(30 if area != "c" else 12, draw.integers(1, 5))):
            price = math.exp(worth + trend[area][at] + draw.normal(0, 0.05))
            rows.append((home, area, months[at], len(rows), price))
    # Two more sets of periods that no pair connects with the others, and odd sales.
    rows += [(5000, "c", months[20], 1, 100.0), (5000, "c", months[25], 2, 130.0), (5001, "c", months[28], 1, 9.0)]
    rows += [(5002, "a", None, 1, 5.0), (5002, "a", months[3], 2, 0.0), (5003, None, months[1], 1, 1.0),
             (5003, None, months[2], 2, 2.0)]
    frame = spark.createDataFrame(rows, "home long, zip_code string, month date, no long, price double")
    args = (["home"], "zip_code", F.col("month"), F.col("price"), ["no"])
    pairs = defaultdict(list)
    for r in sale_pairs(frame, *args).collect():
        pairs[r.zip_code].append((r.from_period, r.to_period, r.rise))
    got = defaultdict(dict)
    for r in repeat_sales_index(frame, *args).collect():
        got[r.zip_code][r.period] = r
    assert set(got) == {"a", "b", "c", None} and got[None][months[2]]["index"] == pytest.approx(2.0)
    for area in "abc":
        own = pairs[area]
        periods = sorted({p for a, b, _ in own for p in (a, b)})
        assert sorted(got[area]) == periods
        x = np.zeros((len(own), len(periods)))
        for i, (a, b, _) in enumerate(own):
            x[i, periods.index(a)], x[i, periods.index(b)] = -1, 1
        level = np.linalg.lstsq(x, np.array([rise for *_, rise in own]), rcond=None)[0]
        counts = Counter(p for a, b, _ in own for p in (a, b))
        for at, p in enumerate(periods):
            base = periods.index(got[area][p].base)
            assert got[area][p]["index"] == pytest.approx(math.exp(level[at] - level[base]))
            assert got[area][p].n_pairs == counts[p]
        assert {got[area][p].base for p in periods} == ({periods[0]} if area != "c" else {periods[0], months[20]})
    assert len(sale_pairs(frame.where("home = 0"), *args).collect()) < 5


def test_repeat_sales_of_nothing(spark):
    none = spark.createDataFrame([], "home long, zip_code string, month date, no long, price double")
    assert repeat_sales_index(none, ["home"], "zip_code", F.col("month"), F.col("price"), ["no"]).collect() == []
