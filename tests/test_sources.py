import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.catalog import book_writer
from pricelab.fixed_values import ASSESSOR_ZIP
from pricelab.schemas import LEDGER_SHEET
from pricelab.sources import workbook
from pricelab.sources.delimited import header, read_csv
from pricelab.sources.documents import read_provider_series
from pricelab.sources.sheets import infer_schema, open_workbooks, read_sheets

NAMES = [f.name for f in LEDGER_SHEET.fields]
SERIAL = (dt.date(2011, 3, 7) - dt.date(1899, 12, 30)).days


def ledger_book(titles, rows):
    return book_writer.write(titles, NAMES, rows, {5})


def sale(price, category="01 ONE FAMILY", zip_code=10301.0):
    return (category, zip_code, 1.0, 1000.0, price, SERIAL)


@pytest.fixture
def books(tmp_path):
    (tmp_path / "2009_a.xlsx").write_bytes(ledger_book(["t", "", "u"], [sale(5000.0), sale(6000.0)]))
    (tmp_path / "2009_b.xlsx").write_bytes(ledger_book(["t", "", "u"], [sale(7000.0, "")]))
    (tmp_path / "2011_a.xlsx").write_bytes(ledger_book(["t", "", "u", "v"], [sale(8000.0)]))
    return tmp_path


def test_header_and_inference(spark, books):
    found = open_workbooks(spark, f"{books}/2009_a.xlsx")
    schema = infer_schema(found, "0!A4")
    assert [(f.name, f.dataType) for f in schema.fields] == [(f.name, f.dataType) for f in LEDGER_SHEET.fields]
    rows = read_sheets(found, data_address="0!A4", header=True).collect()
    assert [r["SALE PRICE"] for r in rows] == [5000.0, 6000.0]
    assert rows[0]["SALE DATE"] == dt.date(2011, 3, 7)


def test_imposed_schema_over_several_books_and_layouts(spark, books):
    older = read_sheets(open_workbooks(spark, f"{books}/2009_*.xlsx"), LEDGER_SHEET, "0!A5")
    newer = read_sheets(open_workbooks(spark, f"{books}/2011_*.xlsx"), LEDGER_SHEET, "0!A6")
    prices = sorted(r["SALE PRICE"] for r in older.unionByName(newer).collect())
    assert prices == [5000.0, 6000.0, 7000.0, 8000.0]


def test_empty_cell_policy(spark, books):
    found = open_workbooks(spark, f"{books}/2009_b.xlsx")
    kept = read_sheets(found, LEDGER_SHEET, "0!A5", empty_as_null=False)
    assert kept.first()["BUILDING CLASS CATEGORY"] == ""
    assert read_sheets(found, LEDGER_SHEET, "0!A5").first()["BUILDING CLASS CATEGORY"] is None


def test_columns_from_an_inner_cell(spark, books):
    schema = T.StructType([T.StructField("zip", T.DoubleType()), T.StructField("units", T.IntegerType())])
    row = read_sheets(open_workbooks(spark, f"{books}/2011_a.xlsx"), schema, "Sales!B6").first()
    assert (row.zip, row.units) == (10301.0, 1)


def test_schema_is_needed_without_header(spark, books):
    with pytest.raises(ValueError):
        read_sheets(open_workbooks(spark, f"{books}/2011_a.xlsx"), data_address="0!A6")


def test_shared_texts_gaps_booleans_errors_and_more_sheets():
    main = workbook.MAIN[1:-1]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{workbook.RELATION_ID[1:-3]}"><sheets>'
            '<sheet name="First" sheetId="1" r:id="a"/><sheet name="Second" sheetId="2" r:id="b"/>'
            "</sheets></workbook>",
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            "<Relationships><Relationship Id='a' Target='worksheets/s1.xml'/>"
            "<Relationship Id='b' Target='/xl/worksheets/s2.xml'/></Relationships>",
        )
        book.writestr(
            "xl/sharedStrings.xml",
            f'<sst xmlns="{main}"><si><t>plain</t></si><si><r><t>rich </t></r><r><t>text</t></r>'
            "<rPh><t>no</t></rPh></si></sst>",
        )
        book.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        book.writestr(
            "xl/worksheets/s2.xml",
            f'<worksheet xmlns="{main}"><sheetData>'
            '<row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c></row>'
            '<row r="5"><c r="B5" t="b"><v>1</v></c><c r="C5" t="e"><v>#N/A</v></c></row>'
            "<row><c/><c/></row><row><c><v>7</v></c></row>"
            "</sheetData></worksheet>",
        )
    content = out.getvalue()
    assert list(workbook.rows(content, "First", 1, 0, 3)) == []

    def texts(sheet):
        return [[text for text, _ in row] for row in workbook.rows(content, sheet, 1, 0, 3)]

    assert texts("Second") == [["plain", "", "rich text"], ["", "1", ""], ["7", "", ""]]
    assert texts("1") == texts("Second")
    assert [r[0][0] for r in workbook.rows(content, "1", 3, 1, 1)] == ["1"]


@pytest.mark.parametrize(
    "address, parts",
    [("0!A4", ("0", 4, 0)), ("'My Sales'!AB12", ("My Sales", 12, 27)), ("C3", ("0", 3, 2))],
)
def test_addresses(address, parts):
    assert workbook.parse_address(address) == parts


def test_csv_reads_only_the_selected_columns(spark, tmp_path):
    path = tmp_path / "roll.csv"
    path.write_text(f'"{ASSESSOR_ZIP}",b,c\n21201-1234,2,x\n,,\n')
    df = read_csv(spark, str(path)).select(header(ASSESSOR_ZIP).alias("zip"))
    assert [r.zip for r in df.collect()] == ["21201-1234", None]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<PREMISE ADDRESS" in plan and "b:string" not in plan


def test_types_come_from_all_workbooks(spark, tmp_path):
    def book(*values):
        return book_writer.write([], ["a", "b", "c"], [(v, None, 1.5) for v in values], set())

    kinds = {"x": book(1.0, 2.0), "y": book("text"), "z": book(None)}
    for order in ("xyz", "zyx", "yzx"):
        found = spark.createDataFrame([(n, kinds[n]) for n in order], "path string, content binary")
        schema = infer_schema(found.repartition(3), "0!A1")
        assert schema.simpleString() == "struct<a:string,b:string,c:double>"
    rows = read_sheets(found, data_address="0!A1", header=True).collect()
    assert sorted(str(r.a) for r in rows) == ["1.0", "2.0", "None", "text"]
    other = book_writer.write([], ["a", "b", "d"], [], set())
    with pytest.raises(ValueError, match="different headers"):
        infer_schema(spark.createDataFrame([("x", kinds["x"]), ("o", other)], found.schema), "0!A1")


def test_timestamps_and_other_types(spark):
    content = book_writer.write([], ["a"], [(43831.5,)], set())
    found = spark.createDataFrame([("x", content)], "path string, content binary")

    def read(kind):
        schema = T.StructType([T.StructField("a", kind)])
        return read_sheets(found, schema, "0!A2").select(F.col("a").cast("string")).first()[0]

    assert read(T.TimestampType()) == read(T.TimestampNTZType()) == "2020-01-01 12:00:00"
    assert (read(T.DateType()), read(T.IntegerType())) == ("2020-01-01", "43831")
    with pytest.raises(ValueError, match="array"):
        read(T.ArrayType(T.StringType()))


def test_days_from_1904_are_refused():
    content = book_writer.write([], ["a"], [(1.0,)], set())
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w") as book:
        for name in old.namelist():
            text = old.read(name).decode()
            book.writestr(name, text.replace("<sheets>", '<workbookPr date1904="1"/><sheets>'))
    with pytest.raises(ValueError, match="1904"):
        list(workbook.rows(out.getvalue(), "0", 1, 0))


def test_csv_headers_in_another_order_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("zip,price\n1,100\n")
    (tmp_path / "b.csv").write_text("price,zip\n200,2\n")
    for options in ({}, {"infer": True}, {"schema": "zip string, price string"}):
        with pytest.raises(Exception, match="(?i)header"):
            read_csv(spark, str(tmp_path), **options).collect()
        with pytest.raises(Exception, match="(?i)header"):
            read_csv(spark, str(tmp_path), **options).select("zip").collect()
    assert read_csv(spark, f"{tmp_path}/b.csv").select("zip").first().zip == "2"


def test_csv_inference_and_schema(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text("a,b\n1,2.5\n")
    assert [t for _, t in read_csv(spark, str(path), infer=True).dtypes] == ["int", "double"]
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    assert read_csv(spark, str(path), schema).first().a == 1


def test_provider_documents(spark, tmp_path):
    def put(name, code, data):
        document = {"dataset": {"dataset_code": code, "data": data, "other": 1}}
        with open(tmp_path / name, "a") as file:
            file.write(json.dumps(document) + "\n")

    put("Z10001_MSPAH.json", "Z10001_MSPAH", [["2019-05-31", 1.5], ["2019-06-30", None], ["2019-07-31"]])
    put("Z10001_MSPAH.json", "Z10001_MSPAH", [])
    put("Z00501_MSPFCO.json", "Z00501_MSPFCO", [["2019-05-31", "2"], ["", "n/a"]])
    put("Z00501_OTHER.json", "Z00501_OTHER", None)
    got = read_provider_series(spark, [f"{tmp_path}/Z*_MSPAH.json", f"{tmp_path}/Z*_MSPFCO.json"])
    may, june, july = dt.date(2019, 5, 31), dt.date(2019, 6, 30), dt.date(2019, 7, 31)
    assert sorted(got.collect(), key=str) == sorted(
        [
            ("MSPAH", "10001", may, 1.5),
            ("MSPAH", "10001", june, None),
            ("MSPAH", "10001", july, None),
            ("MSPFCO", "00501", may, 2.0),
            ("MSPFCO", "00501", None, None),
        ],
        key=lambda t: str(spark.createDataFrame([t], got.schema).first()),
    )
    assert read_provider_series(spark, f"{tmp_path}/Z*_OTHER.json").count() == 0
    assert got.where(F.col("price").isNull()).count() == 3
