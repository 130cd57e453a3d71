import pytest
from pyspark.sql import types as T

from ledgerloom import catalog
from ledgerloom.specs import (
    JoinSpec,
    MartSpec,
    TableSpec,
    column_type,
    struct_from_columns,
    write_mode,
)


@pytest.mark.parametrize(
    "name, expected",
    [
        ("string", T.StringType()),
        ("IntegerType", T.IntegerType()),
        ("LONG", T.LongType()),
        ("double", T.DoubleType()),
        ("BooleanType", T.BooleanType()),
        ("date", T.DateType()),
        ("TimestampType", T.TimestampType()),
        ("DecimalType", T.DecimalType(10, 2)),
        ("decimal(12)", T.DecimalType(12, 2)),
        ("decimal(12,3)", T.DecimalType(12, 3)),
        ("DecimalType(8, 1)", T.DecimalType(8, 1)),
        ("decimal(x,1)", T.DecimalType(10, 2)),
        ("blob", T.StringType()),
        (None, T.StringType()),
    ],
)
def test_column_type(name, expected):
    assert column_type(name) == expected


def test_struct_from_columns():
    schema = struct_from_columns([{"name": "a", "type": "date", "nullable": False}, {"name": "b"}])
    assert [(f.name, f.dataType, f.nullable) for f in schema.fields] == [
        ("a", T.DateType(), False),
        ("b", T.StringType(), True),
    ]
    with pytest.raises(ValueError):
        struct_from_columns([])


def test_write_mode():
    assert [write_mode(m) for m in ("incremental", "full", "other")] == [
        "append", "overwrite", "overwrite",
    ]


def test_bad_declarations_are_refused():
    schema = struct_from_columns([{"name": "id"}])
    with pytest.raises(ValueError, match="format"):
        TableSpec("t", "xml", "id", schema)
    with pytest.raises(ValueError, match="key"):
        TableSpec("t", "csv", "no", schema)
    with pytest.raises(ValueError, match="CSV"):
        TableSpec("t", "json", "id", schema, change_columns=("id",))
    with pytest.raises(ValueError):
        JoinSpec("r", "a", "a", "cross")
    with pytest.raises(ValueError):
        MartSpec((), {"n": "count(1)"})


def test_catalog_is_complete():
    assert list(catalog.TABLES) == [
        "orders", "customers", "products", "dms_orders", "dms_customers", "dms_products", "api_pricing",
    ]
    assert [len(s) for s in (catalog.ORDERS_SCHEMA, catalog.CUSTOMERS_SCHEMA)] == [15, 15]
    assert [len(s) for s in (catalog.PRODUCTS_SCHEMA, catalog.PRICING_SCHEMA)] == [14, 8]
    assert len(catalog.TABLES["dms_orders"].change_columns) == 17
    assert len(catalog.FACT_WIDE) == 18 and len(catalog.MARTS) == 5
