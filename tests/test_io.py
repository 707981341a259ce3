import datetime as dt
import json
from pathlib import Path

import pytest

from tillroll.operators.cleaning import add_revenue
from tillroll.operators.metrics import daily_sales
from tillroll.sources import (
    RETAIL_SCHEMA,
    load_checked_sales,
    load_sales_data,
    query_sales,
    read_lines_parquet,
    register_sales,
    reject_counts,
    rejected_cells,
    write_csv,
    write_json_document,
    write_parquet,
)

CSV = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
800201,ZX-9,"LAMP, GREEN",6,2010-12-01 08:26:00,2.15,601.0,Norway
C800202,ZX-7,,x,2010-12-01 08:28:00,3.25,,Spain
"""


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_with_the_fixed_schema(spark, csv_file):
    df = load_sales_data(spark, csv_file)
    assert df.schema == RETAIL_SCHEMA
    good, bad = df.orderBy("InvoiceNo").collect()
    assert good["Description"] == "LAMP, GREEN"
    assert good["InvoiceDate"] == dt.datetime(2010, 12, 1, 8, 26)
    assert (bad["Description"], bad["Quantity"], bad["CustomerID"]) == (None, None, None)


def test_csv_with_inferred_types(spark, csv_file):
    types = dict(load_sales_data(spark, csv_file, infer_schema=True).dtypes)
    assert types["UnitPrice"] == "double" and types["InvoiceDate"] == "timestamp"
    assert types["Quantity"] == "string"


def test_csv_round_trip(spark, make_lines, tmp_path):
    lines = make_lines(
        {"InvoiceNo": "1", "Description": 'a "quoted", name'},
        {"InvoiceNo": "2", "CustomerID": None},
        {"InvoiceNo": "3", "UnitPrice": 0.1},
    )
    stamped = lines.withColumn("InvoiceDate", lines["InvoiceDate"].cast("string"))
    write_csv(stamped, str(tmp_path / "out"))
    back = load_sales_data(spark, str(tmp_path / "out"))
    assert sorted(back.collect(), key=str) == sorted(lines.collect(), key=str)


def parts(folder: Path, suffix: str):
    return sorted(p for p in folder.iterdir() if p.name.startswith("part") and p.suffix == suffix)


def test_a_report_is_one_ordered_file(spark, make_lines, tmp_path):
    lines = make_lines(*[{"InvoiceDate": dt.datetime(2011, 1, d)} for d in range(1, 29)])
    report = daily_sales(add_revenue(lines.repartition(5)))
    write_csv(report, str(tmp_path / "report"), order_by=["sale_date"], files=1)
    (file,) = parts(tmp_path / "report", ".csv")
    header, *rows = file.read_text().splitlines()
    assert header == "sale_date,daily_revenue,transactions,units_sold"
    assert rows == sorted(rows) and len(rows) == 28


def test_the_number_of_files_is_the_callers(spark, tmp_path):
    rows = spark.range(100).repartition(6)
    for files in (1, 3):
        write_csv(rows, str(tmp_path / "report"), files=files)
        assert len(parts(tmp_path / "report", ".csv")) == files
    write_csv(rows, str(tmp_path / "ordered"), ["id"], files=2)
    first, second = (f.read_text().split()[1:] for f in parts(tmp_path / "ordered", ".csv"))
    assert [*map(int, first), *map(int, second)] == list(range(100)) and first and second


def test_parquet_round_trip(spark, make_lines, tmp_path):
    lines = make_lines({"InvoiceNo": "1"}, {"InvoiceNo": "2", "CustomerID": None})
    write_parquet(lines, str(tmp_path / "out"))
    write_parquet(lines, str(tmp_path / "out"))
    back = read_lines_parquet(spark, str(tmp_path / "out"))
    assert sorted(back.collect(), key=str) == sorted(lines.collect(), key=str)


def test_json_document_keeps_nulls(spark, tmp_path):
    df = spark.sql("SELECT 'a' AS task, named_struct('x', 1, 'y', CAST(NULL AS INT)) AS m")
    write_json_document(df, str(tmp_path / "doc"))
    (file,) = [f for f in parts(tmp_path / "doc", ".txt") if f.stat().st_size]
    assert json.loads(file.read_text()) == {"task": "a", "m": {"x": 1, "y": None}}


def test_named_relation(spark, make_lines):
    lines = register_sales(make_lines({"Quantity": 2}, {"Quantity": 3}), "sales")
    assert spark.sql("SELECT sum(Quantity) FROM sales").first()[0] == 5
    assert query_sales(lines, "SELECT count(*) FROM {sales} WHERE Quantity > 2").first()[0] == 1
    spark.catalog.dropTempView("sales")


MESSY = """InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country
1,A,plain,6,2010-12-01 08:26:00,2.5,601.0,Norway
2,B,bad cells,six,01/12/2010,2.x,?,Norway
3,C,"too, few",4,2010-12-01 08:28:00
4,D,too many,4,2010-12-01 08:28:00,1.5,7.0,Spain,extra
5,,,,,,,
6,F,odd numbers,3000000000,2010-02-30 00:00:00,1e400,-.5e1,Spain
7,G,shapes,+7,2010-12-01 08:28:00,.5,NaN,Spain
"""


def test_rejected_cells_stand_beside_their_rows(spark, tmp_path):
    path = tmp_path / "messy.csv"
    path.write_text(MESSY)
    checked = load_checked_sales(spark, str(path))
    assert checked.columns == [*RETAIL_SCHEMA.fieldNames(), "rejects"]
    rows = {r["InvoiceNo"]: r for r in checked.collect()}
    assert sorted(rows) == list("1234567")
    found = {k: [tuple(x) for x in r["rejects"]] for k, r in rows.items()}
    assert found["1"] == found["5"] == found["7"] == []
    assert found["2"] == [
        ("Quantity", "six", "not an integer"),
        ("InvoiceDate", "01/12/2010", "not a time"),
        ("UnitPrice", "2.x", "not a number"),
        ("CustomerID", "?", "not a number"),
    ]
    assert [(c, reason) for c, _, reason in found["3"]] == [(None, "wrong number of fields")]
    assert found["4"][0][1].endswith("Spain,extra") and rows["4"]["Country"] == "Spain"
    assert [c for c, _, _ in found["6"]] == ["Quantity", "InvoiceDate"]
    assert (rows["7"]["Quantity"], rows["7"]["UnitPrice"], rows["6"]["CustomerID"]) == (7, 0.5, -5.0)
    assert rejected_cells(checked).count() == 8
    counts = {(r["column"], r["reason"]): r["n_cells"] for r in reject_counts(checked).collect()}
    assert counts[("Quantity", "not an integer")] == 2 and counts[(None, "wrong number of fields")] == 2
    plain = {r["InvoiceNo"]: r for r in load_sales_data(spark, str(path)).collect()}
    for name in RETAIL_SCHEMA.fieldNames():
        assert all(repr(plain[k][name]) == repr(rows[k][name]) for k in rows), name


def test_an_empty_file_has_no_rejects(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text(MESSY.splitlines()[0] + "\n")
    assert load_checked_sales(spark, str(path)).count() == 0
    assert rejected_cells(load_checked_sales(spark, str(path))).count() == 0
