import datetime as dt

from pyspark.sql import functions as F

from pricelab import functions as P


def values(spark, column, rows, type_name):
    df = spark.createDataFrame([(r,) for r in rows], f"v {type_name}")
    return [r[0] for r in df.select(column(F.col("v"))).collect()]


def test_zip_from_int(spark):
    assert values(spark, P.zip_from_int, [501, 0, None, 99999], "int") == ["00501", "00000", None, "99999"]


def test_zip_from_double(spark):
    assert values(spark, P.zip_from_double, [501.0, 0.0, None], "double") == ["00501", "00000", None]


def test_zip_from_text(spark):
    given = ["21201-1234", "501", " 21201 ", "21201.0", "", None, "n/a", "212011234"]
    assert values(spark, P.zip_from_text, given, "string") == [
        "21201", "00501", "21201", "21201", None, None, None, "21201",
    ]


def test_unknown_zips_are_told_apart(spark):
    given = ["00000", "00501", None, "21201"]
    df = spark.createDataFrame([(g,) for g in given], "v string")
    assert [r.v for r in df.where(P.is_known_zip(F.col("v"))).collect()] == ["00501", "21201"]


def test_null_double_zip_is_dropped(spark):
    df = spark.createDataFrame([(None,), (0.0,), (10301.0,)], "v double")
    kept = df.where(P.is_known_zip(P.zip_from_double(F.col("v")))).collect()
    assert [r.v for r in kept] == [10301.0]


def test_dotted_date(spark):
    given = ["2019.05.31", "0000.00.00", "", None, "2019.13.01", "x"]
    assert values(spark, P.dotted_date, given, "string") == [dt.date(2019, 5, 31)] + [None] * 5


def test_iso_date(spark):
    given = ["2019-05-31", "2019-05", "", None, "31/05/2019"]
    assert values(spark, P.iso_date, given, "string") == [
        dt.date(2019, 5, 31), dt.date(2019, 5, 1), None, None, None,
    ]


def test_yyyymm_date(spark):
    assert values(spark, P.yyyymm_date, [201905, None, 201913], "int") == [dt.date(2019, 5, 1), None, None]
    assert values(spark, P.yyyymm_date, ["201905", ""], "string") == [dt.date(2019, 5, 1), None]


def test_month_start(spark):
    assert values(spark, P.month_start, [dt.date(2019, 5, 31), None], "date") == [dt.date(2019, 5, 1), None]


def test_text_codes(spark):
    assert values(spark, P.first_token, ["STRY 2 Story (02)", "STRY", None], "string") == ["STRY", "STRY", None]
    assert values(spark, P.bracket_code, ["STRY (02) (03)", "STRY", None], "string") == ["02", "", None]
    assert values(spark, P.class_code, ["01 ONE FAMILY", None], "string") == ["01", None]
    assert values(spark, P.class_description, ["01  ONE FAMILY ", None], "string") == ["ONE FAMILY", None]


def test_unit_price(spark):
    df = spark.createDataFrame([(5000.0, 0.0), (5000.0, None), (5000.0, 4.0)], "p double, a double")
    assert [r[0] for r in df.select(P.unit_price(F.col("p"), F.col("a"))).collect()] == [None, None, 1250.0]


def test_amounts(spark):
    assert values(spark, P.to_amount, ["12.5", "", "n/a", None], "string") == [12.5, None, None, None]
