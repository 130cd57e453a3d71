import glob
from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators.dedup import latest_per_key
from ledgerloom.operators.quality import QualityGateError
from ledgerloom.plans import (
    RepeatedOrderError,
    bronze,
    bronze_table,
    enrich_left,
    gold,
    refresh_marts,
    run_bronze,
    run_marts,
    run_medallion,
    run_silver,
    run_silver_enriched,
    silver,
    silver_core,
    silver_table,
)
from ledgerloom.specs import Gate, TableSpec, struct_from_columns
from ledgerloom.sources import write_table
from ledgerloom.streaming import (
    compact_state,
    ingest_stream,
    read_state,
    remove_folded,
    upsert,
    upsert_stream,
)
from ledgerloom.workload import bindings, core_queries, mart_queries

SMALL = Gate(min_rows=1)
ORDER = "{id},{c},{p},2024-01-0{d},1,10.00,1.00,{amount},{status},card,paid,X,Y,1,web"


def spec(name, **changes):
    return replace(catalog.TABLES[name], **{"gate": SMALL, **changes})


@pytest.fixture
def raw(tmp_path):
    """The seven raw tables as small files, with duplicates and bad rows."""
    header = ",".join(catalog.ORDERS_SCHEMA.names)
    orders = [
        ORDER.format(id=1, c=1, p=1, d=1, amount="100.00", status="delivered"),
        ORDER.format(id=1, c=1, p=1, d=1, amount="100.00", status="delivered"),
        ORDER.format(id=2, c=2, p=1, d=2, amount="50.00", status="delivered"),
        ORDER.format(id=3, c=1, p=2, d=3, amount="70.00", status="cancelled"),
        ORDER.format(id=4, c=1, p=2, d=3, amount="n/a", status="delivered"),
        ORDER.format(id=5, c=9, p=1, d=3, amount="60.00", status="delivered"),
        ORDER.format(id=6, c=1, p=2, d=4, amount="6000.00", status="delivered"),
    ]
    feed = [
        "U," + ORDER.format(id=2, c=1, p=1, d=2, amount="55.00", status="returned") + ",2024-02-01,2024-02-02",
        "I," + ORDER.format(id=7, c=2, p=2, d=5, amount="10.00", status="delivered") + ",2024-02-01,2024-02-01",
        "D," + ORDER.format(id=6, c=1, p=2, d=4, amount="0.00", status="x") + ",2024-02-01,2024-02-03",
    ]
    person = (
        '{{"customer_id": {i}, "customer_name": "N{i}", "date_of_birth": "2000-01-01", "city": "X",'
        ' "is_active": {a}, "registered_date": "2020-01-01"}}'
    )
    price = (
        '{{"product_id": {i}, "product_name": "P", "category": "c", "base_price": 1,'
        ' "final_price": {f}, "price_date": "2024-01-0{d}"}}'
    )
    files = {
        "orders/a.csv": "\n".join([header, *orders]),
        "dms_orders/a.csv": "\n".join(feed),
        "customers/a.json": f"[{person.format(i=1, a='true')},\n{person.format(i=2, a='false')}]",
        "dms_customers/a.csv": "U,2,New,,,F,2001-01-01,Z,,,2021-01-01,web,card,true,true,gold,2024-01-01,2024-02-01",
        "dms_products/a.csv": "I,3,P3,b,c,s,10,9,5,1,1,4,1,true,2020-01-01,2024-01-01,2024-01-01",
        "api_pricing/a.json": f"[{price.format(i=1, f=8, d=1)}, {price.format(i=1, f=9, d=2)}]",
    }
    for name, text in files.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text + "\n")
    return {name: str(tmp_path / "raw" / name) for name in catalog.TABLES}


@pytest.fixture
def products(spark, raw):
    rows = [(i, f"P{i}", "b", "c", "s", True, "2020-01-01") for i in (1, 2)]
    names = "product_id int, product_name string, brand string, category string, sub_category string"
    df = spark.createDataFrame(rows, f"{names}, is_active boolean, launch_date string")
    df = df.withColumns({"mrp": F.lit("10"), "selling_price": F.lit("9")})
    df.write.mode("overwrite").parquet(raw["products"])
    return raw["products"]


def test_bronze_orders(spark, raw, tmp_path):
    target, bad = str(tmp_path / "bronze"), str(tmp_path / "bad")
    counts = run_bronze(spark, spec("orders"), raw["orders"], target, bad)
    assert counts == {"read": 7, "quarantined": 1, "clean": 6, "written": 5}
    got = spark.read.parquet(target)
    assert sorted(r.order_id for r in got.collect()) == [1, 2, 3, 5, 6]
    assert glob.glob(f"{target}/load_id=1/order_date=2024-01-01/*.parquet")
    assert got.where("bronze_source_file not like '%a.csv' or bronze_loaded_at is null").count() == 0
    assert spark.read.json(bad).count() == 1
    again = run_bronze(spark, spec("orders"), raw["orders"], target, bad)
    assert set(again.values()) == {0}
    assert spark.read.parquet(target).count() == 5 and spark.read.json(bad).count() == 1
    changed = ORDER.format(id=1, c=1, p=1, d=1, amount="99.00", status="changed")
    with open(f"{raw['orders']}/later.csv", "w") as f:
        f.write(",".join(catalog.ORDERS_SCHEMA.names) + "\n" + changed + "\n")
    later = spec("orders", gate=Gate(min_rows=1))
    assert run_bronze(spark, later, raw["orders"], target, bad)["written"] == 1
    latest = bronze_table(spark, later, target)
    assert latest.count() == 5 and latest.where("order_id = 1").first().status == "changed"


def test_failed_load_is_taken_again(spark, raw, tmp_path):
    target, bad = str(tmp_path / "bronze"), str(tmp_path / "bad")
    for _ in range(2):
        with pytest.raises(QualityGateError, match="min_rows"):
            run_bronze(spark, spec("orders", gate=Gate(min_rows=7)), raw["orders"], target, bad)
    assert spark.read.json(bad).count() == 1
    assert run_bronze(spark, spec("orders"), raw["orders"], target, bad)["written"] == 5


def test_gate_stops_before_the_target(spark, raw, tmp_path):
    target = str(tmp_path / "bronze")
    with pytest.raises(QualityGateError, match="min_rows"):
        run_bronze(spark, spec("orders", gate=Gate(min_rows=7)), raw["orders"], target, str(tmp_path / "bad"))
    with pytest.raises(QualityGateError, match="quarantine"):
        gate = Gate(max_quarantine_percent=10)
        run_bronze(spark, spec("orders", gate=gate), raw["orders"], target, str(tmp_path / "bad"))
    assert not glob.glob(f"{target}/*")


def test_bronze_full_load_of_nothing_keeps_the_table(spark, tmp_path):
    schema = struct_from_columns([{"name": "id", "type": "integer"}])
    table = TableSpec("t", "parquet", "id", schema, gate=Gate(fail_on_zero_rows=False))
    target, source = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(3).write.parquet(source)
    assert run_bronze(spark, table, source, target, str(tmp_path / "q"))["written"] == 3
    spark.range(0).write.mode("overwrite").parquet(source)
    assert run_bronze(spark, table, source, target, str(tmp_path / "q"))["written"] == 0
    assert spark.read.parquet(target).count() == 3


def test_all_layers(spark, raw, products, tmp_path, rows):
    root = str(tmp_path / "lake")
    specs = {n: spec(n) for n in catalog.TABLES}
    counts = run_medallion(spark, specs, raw, root, as_of="2024-06-30")
    assert counts["dms_orders"] == {"read": 2, "quarantined": 0, "clean": 2, "written": 2}

    core = spark.read.parquet(f"{root}/gold/core/fact_orders")
    assert sorted(r.order_id for r in core.collect()) == [1, 6]
    daily = spark.read.parquet(f"{root}/gold/core/agg_daily_revenue")
    assert {r.order_date.day: float(r.total_revenue_with_gst) for r in daily.collect()} == {1: 118.0, 4: 7080.0}
    names = {p.rsplit("/", 1)[-1] for p in glob.glob(f"{root}/gold/core/*")}
    assert names == {
        "fact_orders", "dim_customers", "dim_products", "dim_date",
        "agg_daily_revenue", "agg_city_orders", "agg_product_sales",
    }

    wide = {r.order_id: r for r in spark.read.parquet(f"{root}/silver/enriched_orders").collect()}
    assert set(wide) == {1, 2, 3, 5, 6, 7}
    assert wide[2].status == "returned" and float(wide[2].net_amount) == 54.0
    assert wide[5].customer_name is None and wide[7].customer_name == "New"
    assert float(wide[1].final_price) == 9.0 and wide[3].final_price is None
    assert wide[6].is_high_value and wide[1].customer_age == 24
    assert not {"created_at", "updated_at", "customer_updated_at"} & set(wide[1].asDict())
    assert len(glob.glob(f"{root}/gold/marts/*")) == 9
    lifetime = spark.read.parquet(f"{root}/gold/marts/mart_customer_lifetime")
    assert {r.customer_id: r.order_count for r in lifetime.collect()} == {1: 4, 2: 1, 9: 1}
    assert spark.read.parquet(f"{root}/gold/marts/dim_date").count() == 1826


@pytest.fixture
def loaded(spark):
    orders = spark.createDataFrame(
        [(i, i % 3, 1, "open", i * 10) for i in range(10)],
        "order_id int, customer_id int, product_id int, status string, total_amount int",
    ).withColumn("bronze_loaded_at", F.timestamp_seconds("order_id"))
    orders = orders.withColumn("total_amount", F.col("total_amount").cast("decimal(10,2)"))
    customers = spark.createDataFrame([(i, i != 2) for i in range(3)], "customer_id int, is_active boolean")
    return orders, customers, spark.createDataFrame([(1, True)], "product_id int, is_active boolean")


def test_incremental_silver_equals_full(spark, loaded, tmp_path, rows):
    orders, customers, products = loaded
    target, marks = str(tmp_path / "silver"), str(tmp_path / "marks")

    def run(seen):
        return run_silver(
            spark, seen, customers, products, target, load_mode="incremental", marks=marks
        )

    first = orders.where("order_id < 6")
    assert run(first) and run(orders) and not run(orders)
    columns = ["order_id", "customer_id", "grand_total"]
    got = silver_table(spark, target)
    assert rows(got.select(*columns)) == rows(silver_core(*loaded).select(*columns))
    assert spark.read.parquet(target).select("load_batch").distinct().count() == 2


def test_repeated_run_replaces_its_output(spark, loaded, tmp_path):
    orders, customers, products = loaded
    target = str(tmp_path / "silver")
    for marks in ("lost", "kept"):  # the first run's mark is lost
        run_silver(
            spark, orders, customers, products, target,
            load_mode="incremental", marks=str(tmp_path / marks),
        )
    assert silver_table(spark, target).count() == silver_core(*loaded).count()


def test_full_silver(spark, loaded, tmp_path):
    orders, customers, products = loaded
    target = str(tmp_path / "silver")
    assert run_silver(spark, orders, customers, products, target)
    assert not run_silver(spark, orders.limit(0), customers, products, target)
    assert spark.read.parquet(target).count() == 7


def test_enriched_orders_stay_unique(spark, tmp_path):
    orders = spark.createDataFrame(
        [(i % 4, i % 2, i % 3, "2024-01-01", 10, 1) for i in range(12)],
        "order_id int, customer_id int, product_id int, order_date string, total_amount int, discount_amount int",
    ).withColumn("order_date", F.to_date("order_date"))
    people = spark.createDataFrame(
        [(0, "a"), (0, "b")], "customer_id int, customer_name string"
    ).withColumn("date_of_birth", F.lit(None).cast("date"))
    goods = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z")], "product_id int, product_name string")
    prices = spark.createDataFrame([(0, "2024-01-01", 5), (0, "2024-01-02", 6)], "product_id int, price_date string, final_price int")
    sources = {"orders": orders, "customers": people, "products": goods, "api_pricing": prices}
    plain = enrich_left(sources, as_of="2024-01-01")
    assert plain.count() == plain.select("order_id").distinct().count() == 4
    empty = {**sources, "orders": orders.limit(0)}
    assert not run_silver_enriched(spark, empty, str(tmp_path / "none"))


def test_stream_takes_each_file_once(spark, raw, tmp_path):
    target, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    ingest_stream(spark, spec("orders"), raw["orders"], target, checkpoint)
    ingest_stream(spark, spec("orders"), raw["orders"], target, checkpoint)
    assert spark.read.parquet(target).count() == 7
    extra = ORDER.format(id=8, c=1, p=1, d=5, amount="1.00", status="open")
    with open(f"{raw['orders']}/b.csv", "w") as f:
        f.write(",".join(catalog.ORDERS_SCHEMA.names) + "\n" + extra + "\n")
    ingest_stream(spark, spec("orders"), raw["orders"], target, checkpoint, max_files_per_trigger=1)
    assert spark.read.parquet(target).where("order_id = 8").count() == 1


def test_upserts_with_late_changes(spark, tmp_path, rows):
    source, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "check"))
    at = lambda d: datetime(2024, 1, d)
    batches = [
        [("I", 1, at(2), "a"), ("I", 2, at(1), "b"), ("I", 2, at(2), "b2")],
        [("D", 1, at(3), None), ("I", 3, at(1), "c")],
        [("U", 1, at(1), "late"), ("U", 3, at(4), "c2")],
    ]
    schema = "op string, k int, t timestamp, v string"
    with pytest.raises(ValueError, match="no state"):
        read_state(spark, state, ["k"], "t", "op")
    assert remove_folded(spark, state) == 0
    for number, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        upsert_stream(spark.readStream.schema(schema).parquet(source), state, checkpoint, ["k"], "t")
        if number == 1:
            assert compact_state(spark, state, ["k"], "t") == 1
            assert compact_state(spark, state, ["k"], "t") is None
    got = read_state(spark, state, ["k"], "t", "op").select("k", "v")
    assert rows(got) == [(2, "b2"), (3, "c2")]
    assert remove_folded(spark, state) == 2
    assert rows(read_state(spark, state, ["k"], "t", "op").select("k", "v")) == rows(got)
    # A new checkpoint numbers its batches from 0 again and still adds to the state.
    spark.createDataFrame([("U", 2, at(9), "b9")], schema).write.parquet(f"{source}2")
    upsert_stream(spark.readStream.schema(schema).parquet(f"{source}2"), state, f"{checkpoint}2", ["k"], "t")
    got = read_state(spark, state, ["k"], "t", "op").select("k", "v")
    assert rows(got) == [(2, "b9"), (3, "c2")]


def test_batch_that_lands_while_compacting_stays_pending(spark, tmp_path, rows, monkeypatch):
    state = str(tmp_path / "state")
    schema = "op string, k int, t timestamp, v string"

    def land(number, key):
        row = spark.createDataFrame([("I", key, datetime(2024, 1, 1), "x")], schema)
        row.write.parquet(f"{state}/changes/stream=s/batch_id={number}")

    land(0, 1)
    pending = upsert._pending

    def then_lands(*args):
        found = pending(*args)
        land(1, 2)
        return found

    monkeypatch.setattr(upsert, "_pending", then_lands)
    assert compact_state(spark, state, ["k"], "t") == 1
    monkeypatch.undo()
    assert rows(read_state(spark, state, ["k"], "t", "op").select("k")) == [(1,), (2,)]


def test_unused_columns_are_not_read(spark, sf_dir):
    """The payment mart reads no attribute and no order column that it does not need."""
    plan = mart_queries.mart_payment_analysis(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for column in ("l_quantity", "l_linestatus", "c_acctbal", "c_mktsegment", "n_name", "p_size", "p_brand", "p_retailprice"):
        assert column not in plan


def test_city_orders_read_each_table_once(spark, sf_dir):
    plan = core_queries.agg_city_orders(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for table in ("lineitem", "orders", "customer", "part", "nation", "region"):
        assert plan.count(f"/{table}.parquet") == 1


def test_empty_result_leaves_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).repartition(3)
    assert write_table(rows, path)
    assert not write_table(rows.where("id > 100"), path)
    assert spark.read.parquet(path).count() == 10 and len(glob.glob(f"{path}*")) == 1
    none = rows.where("id > 100").withColumn("v", F.lit(1))
    assert not write_table(none, path, dynamic_overwrite=True, partition_by=("id",))


def test_incremental_enriched_silver_equals_full(spark, tmp_path, rows):
    from datetime import date

    people = spark.createDataFrame([(0, "a")], "customer_id int, customer_name string").withColumn(
        "date_of_birth", F.lit(None).cast("date"))
    goods = spark.createDataFrame([(0, "x")], "product_id int, product_name string")
    prices = spark.createDataFrame([(0, "2024-01-01", 5)], "product_id int, price_date string, final_price int")

    def run(orders, target, **options):
        names = "order_id int, customer_id int, product_id int, order_date date, total_amount int, bronze_loaded_at timestamp"
        frame = spark.createDataFrame(orders, names).withColumns({
            "quantity": F.lit(1), "unit_price": F.lit(1).cast("decimal(10,2)"),
            "discount_amount": F.lit(0).cast("decimal(10,2)"), "status": F.lit("open")})
        sources = {"orders": latest_per_key(frame, ["order_id"], "bronze_loaded_at"), "customers": people,
                   "products": goods, "api_pricing": prices}
        return run_silver_enriched(spark, sources, target, as_of="2024-01-01", **options)

    first = [(i, 0, 0, date(2024, 1, 1 + i % 3), i, datetime(2024, 2, 1)) for i in range(9)]
    later = [(0, 0, 0, date(2024, 1, 9), 50, datetime(2024, 2, 2)), (20, 0, 0, date(2024, 1, 2), 60, datetime(2024, 2, 2))]
    later += [(i, 0, 0, date(2024, 1, 9), 50, datetime(2024, 2, 2)) for i in (3, 6)]  # nothing is left on the 1st
    grown, whole = str(tmp_path / "grown"), str(tmp_path / "whole")
    options = {"load_mode": "incremental", "marks": str(tmp_path / "marks")}
    assert run(first, grown, **options)
    untouched = glob.glob(f"{grown}/order_date=2024-01-03/*.parquet")
    assert run(first + later, grown, **options) and not run(first + later, grown, **options)
    assert run(first + later, whole)
    read = lambda path: spark.read.parquet(path).drop("silver_loaded_at")
    assert rows(read(grown).select(*sorted(read(grown).columns))) == rows(read(whole).select(*sorted(read(grown).columns)))
    assert glob.glob(f"{grown}/order_date=2024-01-03/*.parquet") == untouched
    assert not glob.glob(f"{grown}/order_date=2024-01-01/*.parquet")


def test_incremental_enriched_silver_keeps_orders_without_a_date(spark, tmp_path, rows):
    from datetime import date

    people = spark.createDataFrame([(0, "a")], "customer_id int, customer_name string").withColumn(
        "date_of_birth", F.lit(None).cast("date"))
    goods = spark.createDataFrame([(0, "x")], "product_id int, product_name string")
    prices = spark.createDataFrame([(0, "2024-01-01", 5)], "product_id int, price_date string, final_price int")

    def run(orders, target, **options):
        names = "order_id int, customer_id int, product_id int, order_date date, total_amount int, bronze_loaded_at timestamp"
        frame = spark.createDataFrame(orders, names).withColumns({
            "quantity": F.lit(1), "unit_price": F.lit(1).cast("decimal(10,2)"),
            "discount_amount": F.lit(0).cast("decimal(10,2)"), "status": F.lit("open")})
        sources = {"orders": latest_per_key(frame, ["order_id"], "bronze_loaded_at"), "customers": people,
                   "products": goods, "api_pricing": prices}
        assert run_silver_enriched(spark, sources, target, as_of="2024-01-01", **options)

    day, other = date(2024, 1, 1), date(2024, 1, 2)
    loads = [
        [(0, 0, 0, day, 1, datetime(2024, 2, 1)), (1, 0, 0, None, 2, datetime(2024, 2, 1)), (2, 0, 0, other, 3, datetime(2024, 2, 1))],
        [(0, 0, 0, None, 4, datetime(2024, 2, 2))],  # its day is left
        [(0, 0, 0, other, 5, datetime(2024, 2, 3)), (1, 0, 0, other, 6, datetime(2024, 2, 3))],  # none without a date is left
    ]
    grown, orders = str(tmp_path / "grown"), []
    options = {"load_mode": "incremental", "marks": str(tmp_path / "marks")}
    read = lambda path: spark.read.parquet(path).drop("silver_loaded_at")
    for number, load in enumerate(loads):
        orders += load
        whole = str(tmp_path / f"whole{number}")
        run(orders, grown, **options)
        run(orders, whole)
        names = sorted(read(whole).columns)
        assert rows(read(grown).select(*names)) == rows(read(whole).select(*names))
    assert not glob.glob(f"{grown}/order_date=__HIVE*/*.parquet")


ORDER_ROW = "order_id int, customer_id int, product_id int, status string, total_amount decimal(10,2), bronze_loaded_at timestamp"


def test_incremental_silver_withdraws_orders(spark, tmp_path, rows):
    """Runs after changes of orders, customers and products equal a full run each time."""
    target, marks = str(tmp_path / "silver"), str(tmp_path / "marks")
    at = lambda d: datetime(2024, 1, d)
    orders = {i: (i, i % 4, i % 3, "open", i * 10, at(1)) for i in range(24)}
    people = {i: (i, i != 3, f"name {i}") for i in range(4)}
    goods = {i: (i, True, f"thing {i}") for i in range(3)}
    columns = ["order_id", "customer_id", "status", "customer_name", "product_name", "grand_total"]

    def run():
        frames = (
            spark.createDataFrame([(*o[:4], Decimal(o[4]), o[5]) for o in orders.values()], ORDER_ROW),
            spark.createDataFrame(list(people.values()), "customer_id int, is_active boolean, customer_name string"),
            spark.createDataFrame(list(goods.values()), "product_id int, is_active boolean, product_name string"),
        )
        wrote = run_silver(spark, *frames, target, load_mode="incremental", marks=marks)
        assert rows(silver_table(spark, target).select(*columns)) == rows(silver_core(*frames).select(*columns))
        return wrote

    assert run() and not run()
    orders[1] = (1, 1, 1, "cancelled", 10, at(2))  # cancelled after it was silver
    orders[30] = (30, 0, 0, "cancelled", 10, at(2))  # never was
    assert run()
    people[0] = (0, False, "name 0")  # no order is loaded anew
    assert run() and not run()
    people[0], people[3] = (0, True, "name 0"), (3, True, "new 3")
    goods[2] = (2, False, "thing 2")
    orders[1] = (1, 1, 1, "open", 11, at(3))
    assert run()
    del people[2]
    goods[2], goods[7] = (2, True, "other 2"), (7, True, "thing 7")
    orders[31] = (31, 1, 7, "open", 70, at(4))
    assert run() and not run()
    assert len(glob.glob(f"{marks}_versions/silver/*")) == 1


def enriched_sources(spark, orders, people, goods, prices):
    names = "order_id int, customer_id int, product_id int, order_date date, total_amount int, bronze_loaded_at timestamp"
    frame = spark.createDataFrame(list(orders.values()), names).withColumns({
        "quantity": F.lit(1), "unit_price": F.lit(1).cast("decimal(10,2)"), "discount_amount": F.lit(0).cast("decimal(10,2)"),
        "status": F.lit("open"), "payment_method": F.lit("card"), "payment_status": F.lit("paid"), "order_source": F.lit("web"),
        "shipping_city": F.concat(F.lit("c"), F.col("customer_id") % 2), "shipping_state": F.lit("s")})
    empty = {n: F.lit(None).cast("string") for n in ("email", "phone", "gender", "city", "state", "pincode", "loyalty_tier", "preferred_payment")}
    customers = spark.createDataFrame(list(people.items()), "customer_id int, customer_name string").withColumns({
        **empty, "is_active": F.lit(True), "is_verified": F.lit(True), "registered_date": F.lit("2020-01-01").cast("date"),
        "date_of_birth": F.lit("2000-01-01").cast("date"), "updated_at": F.current_timestamp()})
    numbers = {n: F.lit(1) for n in ("mrp", "selling_price", "discount_percentage", "avg_rating", "review_count")}
    products = spark.createDataFrame(list(goods.items()), "product_id int, category string").withColumns({
        **numbers, "product_name": F.lit("p"), "brand": F.lit("b"), "sub_category": F.lit("s"), "is_active": F.lit(True),
        "launch_date": F.lit("2020-01-01").cast("date")})
    feed = spark.createDataFrame([(k, v, "2024-01-01") for k, v in prices.items()], "product_id int, final_price int, price_date string")
    return {"orders": frame, "customers": customers, "products": products, "api_pricing": feed}


def test_incremental_marts_equal_full(spark, tmp_path, rows):
    """Orders, customers, products and prices change; silver and all marts equal those of a full run."""
    from datetime import date

    root, marks = str(tmp_path), str(tmp_path / "marks")
    at = lambda d: datetime(2024, 3, d)
    days = [date(2024, 1, 5), date(2024, 1, 20), date(2024, 2, 1), date(2023, 12, 31), None]
    orders = {i: (i, i % 6, i % 4, days[i % 5], i * 100, at(1)) for i in range(60)}
    people, goods, prices = {i: f"n{i}" for i in range(6)}, {i: f"c{i % 2}" for i in range(4)}, {i: 10 + i for i in range(4)}

    def run(number):
        sources = enriched_sources(spark, orders, people, goods, prices)
        options = {"as_of": "2024-06-30"}
        run_silver_enriched(spark, sources, f"{root}/silver", load_mode="incremental", marks=marks, **options)
        written = refresh_marts(spark, f"{root}/silver", f"{root}/marts", marks)
        run_silver_enriched(spark, sources, f"{root}/whole{number}", **options)
        names = run_marts(spark, f"{root}/whole{number}", f"{root}/full{number}")
        for name in ("silver", *names):
            grown, whole = (f"{root}/silver", f"{root}/whole{number}") if name == "silver" else (f"{root}/marts/{name}", f"{root}/full{number}/{name}")
            a, b = (spark.read.parquet(x).drop("silver_loaded_at") for x in (grown, whole))
            assert rows(a.select(*sorted(b.columns))) == rows(b.select(*sorted(b.columns))), name
        return written

    files = lambda path: set(glob.glob(f"{root}/{path}/**/*.parquet", recursive=True))
    assert "dim_date" in run(0)
    before = {x: files(x) for x in ("silver/order_date=2024-02-01", "marts/mart_city_trends/order_year=2024/order_month=2", "marts/mart_daily_revenue/order_date=2023-12-31", "marts/fact_orders/order_year=2023")}
    orders[0] = (0, 0, 0, days[1], 5, at(2))  # leaves its day
    orders[70] = (70, 9, 3, days[0], 7, at(2))  # of a customer that is not known yet
    assert "dim_date" not in run(1)
    assert {x: files(x) for x in before} == before and all(before.values())
    assert refresh_marts(spark, f"{root}/silver", f"{root}/marts", marks) == []
    people[9] = "n9"  # its order is not loaded anew
    prices[1] = 99
    goods[2] = "c9"
    run(2)
    for i in [i for i, o in orders.items() if o[3] == date(2023, 12, 31)]:
        orders[i] = (i, 1, 1, None, 1, at(3))  # the only day of its month is left
    del people[4]
    run(3)
    assert not files("marts/fact_orders/order_year=2023") and not files("marts/mart_daily_revenue/order_date=2023-12-31")
    # A refresh that fails before its mark is repeated with the same keys.
    orders[5] = (5, 2, 2, days[2], 8, at(4))
    sources = enriched_sources(spark, orders, people, goods, prices)
    run_silver_enriched(spark, sources, f"{root}/silver", load_mode="incremental", marks=marks, as_of="2024-06-30")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gold, "store_mark", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            refresh_marts(spark, f"{root}/silver", f"{root}/marts", marks)
    assert run(4)


def test_refresh_reads_touched_partitions_only(spark, tmp_path):
    from datetime import date

    days = [date(2024, 1, 5), date(2024, 2, 1), None]
    silver_rows = spark.createDataFrame([(i, days[i % 3]) for i in range(9)], "order_id int, order_date date")
    write_table(silver_rows, str(tmp_path / "silver"), partition_by=("order_date",))
    table = spark.read.parquet(str(tmp_path / "silver"))
    for condition in (gold._within([days[0]]), gold._in_months({(2024, 1)})):
        chosen = table.where(condition)
        assert chosen.count() == 3 and "PartitionFilters: [isnotnull(order_date" in chosen._jdf.queryExecution().executedPlan().toString()
    assert table.where(gold._within([None])).count() == table.where(gold._in_months({(None, None)})).count() == 3


def test_many_files_are_one_load(spark, raw, tmp_path, monkeypatch):
    """Three files taken one at a time: one verdict, one row per key, as if read at once."""
    header = ",".join(catalog.ORDERS_SCHEMA.names)
    for name, first in (("b", 10), ("c", 20)):
        lines = [ORDER.format(id=i, c=1, p=1, d=1, amount="9.00", status="open") for i in range(first, first + 4)]
        lines.append(ORDER.format(id=1, c=1, p=1, d=2, amount=f"{first}.00", status="again"))
        with open(f"{raw['orders']}/{name}.csv", "w") as f:
            f.write("\n".join([header, *lines]) + "\n")
    results = []
    for part, size in (("one", 10_000), ("many", 1)):
        monkeypatch.setattr(bronze, "FILES_PER_READ", size)
        target, bad = str(tmp_path / part), str(tmp_path / f"{part}-bad")
        with pytest.raises(QualityGateError, match="min_rows=16"):  # each file alone has fewer
            run_bronze(spark, spec("orders", gate=Gate(min_rows=17)), raw["orders"], target, bad)
        assert not glob.glob(f"{target}/load_id*")
        counts = run_bronze(spark, spec("orders", gate=Gate(min_rows=16)), raw["orders"], target, bad)
        kept = bronze_table(spark, spec("orders"), target).drop("bronze_loaded_at")
        results.append((counts, sorted(map(tuple, kept.collect())), spark.read.json(bad).count()))
        assert spark.read.parquet(f"{target}/_manifest").count() == 3 and len(glob.glob(f"{target}/load_id=*")) == 1
    assert results[0] == results[1]


def test_repeated_orders_raise(spark, tmp_path, monkeypatch):
    from datetime import date

    orders = {i: (i, i % 2, 0, date(2024, 1, 1 + i), 5, datetime(2024, 2, 1)) for i in range(4)}
    sources = enriched_sources(spark, orders, {0: "a", 1: "b"}, {0: "c"}, {0: 1})
    path = str(tmp_path / "silver")
    run_silver_enriched(spark, sources, path, as_of="2024-06-30")
    run_marts(spark, path, str(tmp_path / "marts"))
    plain = silver.join_chain

    def repeating(frames, joins):
        twice = frames["all_customers"]
        return plain({**frames, "all_customers": twice.union(twice)}, joins)

    monkeypatch.setattr(silver, "join_chain", repeating)
    with pytest.raises(RepeatedOrderError, match="8 rows were made from 4 orders"):
        run_silver_enriched(spark, sources, path, as_of="2024-06-30")
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(RepeatedOrderError):
        run_silver_enriched(spark, sources, str(tmp_path / "grown"), as_of="2024-06-30", load_mode="incremental", marks=str(tmp_path / "marks"))
    monkeypatch.undo()
    twice = spark.read.parquet(path)
    twice.union(twice).write.parquet(str(tmp_path / "twice"))
    with pytest.raises(RepeatedOrderError, match="has 2 rows"):
        run_marts(spark, str(tmp_path / "twice"), str(tmp_path / "more"))


def test_compaction_rewrites_touched_buckets_only(spark, tmp_path, rows):
    state = str(tmp_path / "state")
    schema = "op string, k int, t timestamp, v string"

    def land(number, changes):
        spark.createDataFrame(changes, schema).write.parquet(f"{state}/changes/stream=s/batch_id={number}")

    at = lambda d: datetime(2024, 1, d)
    files = lambda: set(glob.glob(f"{state}/base/**/*.parquet", recursive=True))
    land(0, [("I", k, at(1), "a") for k in range(100)])
    assert compact_state(spark, state, ["k"], "t", buckets=16) == 1
    first = files()
    assert len(first) == 16
    land(1, [("U", 7, at(2), "b")])
    assert compact_state(spark, state, ["k"], "t") == 2
    assert first < files() and len(files() - first) == 1
    land(2, [("D", 8, at(2), None), ("U", 7, at(1), "late")])
    want = [(k, "b" if k == 7 else "a") for k in range(100) if k != 8]
    read = lambda: rows(read_state(spark, state, ["k"], "t", "op").select("k", "v"))
    assert read() == sorted(want, key=repr)
    assert compact_state(spark, state, ["k"], "t") == 3 and read() == sorted(want, key=repr)
    remove_folded(spark, state)
    assert len(files()) == 16 and len(glob.glob(f"{state}/versions/*")) == 1 and not glob.glob(f"{state}/changes/*/*/*.parquet")
    assert read() == sorted(want, key=repr)
    land(3, [("U", 7, at(3), "c")])
    assert compact_state(spark, state, ["k"], "t") == 4 and (7, "c") in read()


def test_wide_orders_join_their_lines_once(spark, sf_dir, rows):
    """Both sources in one frame give what their union gives, and the line items are read once."""
    lines = bindings.order_lines(spark, sf_dir)
    plain, feed = bindings.two_sources(lines.where("order_id % 2 = 0"), "order_id")
    both = bindings.both_sources(lines.where("order_id % 2 = 0"), "order_id")
    want = plain.selectExpr("*", "false as from_feed").unionByName(feed.selectExpr("*", "true as from_feed"), allowMissingColumns=True)
    assert rows(both.select(*sorted(both.columns))) == rows(want.select(*sorted(want.columns)))
    wide = mart_queries.silver_enriched_orders(spark, sf_dir)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_extendedprice#") and len([x for x in plan.splitlines() if "Relation" in x and "l_orderkey" in x]) == 1
    of_two = enrich_left(mart_queries.sources(spark, sf_dir), as_of=mart_queries.AS_OF)
    assert rows(wide) == rows(of_two.select(*mart_queries.ENRICHED_COLUMNS))
