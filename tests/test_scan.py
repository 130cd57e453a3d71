from dataclasses import replace
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators.quality import split_corrupt
from ledgerloom.sources import read_quarantine, scan, write_quarantine
from ledgerloom.specs import CORRUPT_COLUMN, SOURCE_FILE, TableSpec, struct_from_columns

SPEC = TableSpec(
    "orders",
    "csv",
    "id",
    struct_from_columns(
        [
            {"name": "id", "type": "integer"},
            {"name": "day", "type": "date"},
            {"name": "amount", "type": "decimal"},
            {"name": "ok", "type": "boolean"},
            {"name": "note", "type": "string"},
        ]
    ),
    read_options={"header": "true"},
)
LINES = r'''id,day,amount,ok,note
1,2023-01-05,5.50,true,a
2,05-01-2023,1,true,a
3,01/05/2023,1,true,a
4,2023/01/05,1,true,a
5,bad-date,1,true,a
6,,1,true,a
7,2023-01-05,,true,a
8,2023-01-05,-3,false,a
9,2023-01-05,1
10,2023-01-05,1,true,a,extra
11,2023-01-05,"1,000",TRUE,"x, ""y"""
12,2023-1-5, 7,true,a
13,2023-01-05,1,yes,a
14,2023-02-30,123456789012,true,a
x,2023-01-05,1.005,true,
'''
BAD = {"2", "3", "4", "5", "9", "10", "12", "13", "14", "x"}


@pytest.fixture
def source(tmp_path):
    (tmp_path / "orders.csv").write_text(LINES)
    return str(tmp_path)


def test_bad_rows_and_reasons(spark, source):
    rows = scan(spark, SPEC, source)
    _, bad = split_corrupt(rows)
    reasons = {r[CORRUPT_COLUMN].split(",")[0]: r["_corrupt_fields"] for r in bad.collect()}
    assert set(reasons) == BAD
    assert reasons["5"] == "day" and reasons["14"] == "day,amount" and reasons["13"] == "ok"


def test_flags_do_not_depend_on_selected_columns(spark, source):
    flagged = scan(spark, SPEC, source).where(F.col(CORRUPT_COLUMN).isNotNull())
    assert flagged.select("note").count() == len(BAD)
    assert flagged.select(CORRUPT_COLUMN).distinct().count() == len(BAD)
    assert flagged.count() == len(BAD)


def test_agrees_with_typed_reader(spark, source, rows):
    """With every column kept, Spark's own typed reader is a fair witness."""
    names = SPEC.schema.names
    typed = (
        spark.read.option("header", "true")
        .schema(f"{SPEC.schema.toDDL()}, {CORRUPT_COLUMN} string")
        .csv(source)
        .cache()
    )
    ours = scan(spark, SPEC, source)
    flag = F.col(CORRUPT_COLUMN).isNotNull().alias("bad")
    clean_there, clean_here = (
        df.select(*names, flag).where("not bad").drop("bad") for df in (typed, ours)
    )
    assert rows(clean_here.drop("note")) == rows(clean_there.drop("note"))
    assert typed.select(*names, flag).where("bad").count() == len(BAD)
    typed.unpersist()


def test_clean_values(spark, source):
    clean, _ = split_corrupt(scan(spark, SPEC, source))
    got = {r.id: r for r in clean.collect()}
    assert set(got) == {1, 6, 7, 8, 11}
    assert got[1].day == date(2023, 1, 5) and got[1].amount == Decimal("5.50")
    assert got[6].day is None and got[7].amount is None
    assert got[8].amount == Decimal("-3.00") and got[11].amount == Decimal("1000.00")
    assert got[1][SOURCE_FILE].endswith("orders.csv")


def test_quarantine_keeps_raw_text(spark, source, tmp_path):
    clean, bad = split_corrupt(scan(spark, SPEC, source))
    path = str(tmp_path / "quarantine")
    write_quarantine(bad, path)
    write_quarantine(bad, path)
    kept = read_quarantine(spark, path, bad.schema)
    assert kept.count() == 2 * len(BAD)
    assert kept.where("id = 5").first()[CORRUPT_COLUMN] == "5,bad-date,1,true,a"
    assert clean.count() + bad.count() == LINES.count("\n") - 1


def test_json_arrays(spark, tmp_path):
    spec = replace(SPEC, source_format="json", read_options={"multiLine": "true"})
    (tmp_path / "a.json").write_text(
        '[{"id": 1, "day": "2023-01-05", "amount": 5.5, "ok": true, "note": "a", "other": 1},\n'
        '{"id": "x", "day": null, "amount": "1,5"}, {"id": 3}]'
    )
    (tmp_path / "broken.json").write_text('[{"id": 4}, {"id": 5,')
    clean, bad = split_corrupt(scan(spark, spec, str(tmp_path)))
    assert sorted(r.id for r in clean.collect()) == [1, 3]
    assert "other" not in clean.columns
    assert clean.where("id = 1").first().amount == Decimal("5.50")
    assert {r["_corrupt_fields"] for r in bad.collect()} == {"id", None}


def test_nested_customers(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '[{"customer_id": 1, "customer_name": "A", "phone": ["1", "2"],'
        ' "address": {"city": "X", "state": "Y", "pincode": "9"}, "is_active": true},'
        ' {"customer_id": 2, "customer_name": "B", "phone": [], "address": null}]'
    )
    flat = scan(spark, catalog.TABLES["customers"], str(tmp_path))
    assert [r.phone for r in flat.orderBy("customer_id").collect()] == ['["1","2"]', "[]"]
    spec = replace(catalog.TABLES["customers"], json_paths=catalog.NESTED_CUSTOMER_PATHS)
    lifted = scan(spark, spec, str(tmp_path)).orderBy("customer_id").collect()
    assert [(r.phone, r.city, r.pincode) for r in lifted] == [("1", "X", "9"), (None, None, None)]


def test_change_feed(spark, tmp_path):
    spec = TableSpec("t", "csv", "id", SPEC.schema, change_columns=("id", "amount", "updated_at"))
    (tmp_path / "f.csv").write_text("I,1, 5 ,2023-01-01\nU,1,x,2023-01-02\nD,2,,\n,3,1,\nI,4\n")
    rows = scan(spark, spec, str(tmp_path))
    assert dict(rows.dtypes)["updated_at"] == "string"
    clean, bad = split_corrupt(rows)
    assert sorted((r._op or "", r.id, r.amount) for r in clean.collect()) == [
        ("", 3, Decimal("1.00")), ("D", 2, None), ("I", 1, Decimal("5.00")),
    ]
    assert bad.count() == 2
