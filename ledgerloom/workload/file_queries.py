"""Scans, sinks, incremental loads, streams and whole layers, over files that
Spark writes from the benchmark tables into the shared scratch folder."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import catalog
from ledgerloom.operators.dedup import dedup_by_key, union_sources
from ledgerloom.operators.incremental import batch_label, next_mark, read_mark, since, store_mark
from ledgerloom.operators.passes import passes_for, slices
from ledgerloom.operators.quality import split_corrupt
from ledgerloom.plans.bronze import FILES_PER_READ, bronze_table, run_bronze
from ledgerloom.plans.medallion import run_medallion
from ledgerloom.plans.silver import run_silver, silver_table
from ledgerloom.sources.files import CORRUPT_FIELDS, scan
from ledgerloom.sources.listing import list_files, manifest_entries, new_files
from ledgerloom.sources.scratch import scratch_path, shuffles_removed, store
from ledgerloom.sources.sinks import MAX_RECORDS_PER_FILE, read_quarantine, write_quarantine, write_table
from ledgerloom.specs import CORRUPT_COLUMN, LOADED_AT, SOURCE_FILE, Gate, TableSpec
from ledgerloom.streaming import compact_state, ingest_stream, read_state, upsert_stream
from ledgerloom.workload import bindings as b
from ledgerloom.workload.registry import query
from ledgerloom.workload.sql import day, mean, total, with_ctes


def wide_keys(schema: T.StructType) -> T.StructType:
    """The schema with bigint keys and wide amounts, as the benchmark tables have."""
    widened = {T.IntegerType(): T.LongType(), T.DecimalType(10, 2): T.DecimalType(18, 2)}
    return T.StructType(
        [
            T.StructField(f.name, widened.get(f.dataType, f.dataType), f.nullable)
            for f in schema.fields
        ]
    )


def spec_of(name: str, **changes) -> TableSpec:
    """A declared table for the benchmark data.

    Not partitioned by day: these orders spread a few rows over each of
    thousands of days.
    """
    spec = catalog.TABLES[name]
    return replace(spec, schema=wide_keys(spec.schema), partition_by=(), **changes)


# --- raw files ----------------------------------------------------------------

def _made_once(make):
    """The files of a maker are made once per application and input folder."""
    made = {}

    def paths(spark: SparkSession, sf: str):
        key = (spark.sparkContext.applicationId, sf)
        if key not in made:
            made[key] = make(spark, sf)
        return made[key]

    return paths


def raw_orders(spark: SparkSession, sf: str) -> str:
    """Order headers in the layout of the orders file, as CSV with a header.

    Every 50th order has an unreadable date, every 90th an amount that is not a
    number, and every 70th no amount.
    """
    key = F.col("order_id")
    headers = b.order_headers(spark, sf)
    text = {
        "order_date": F.when(key % 50 == 0, "bad-date").otherwise(F.col("order_date").cast("string")),
        "total_amount": F.when(key % 90 == 0, "n/a")
        .when(key % 70 != 0, F.col("total_amount").cast("string")),
    }
    columns = [
        text.get(c, F.col(c) if c in headers.columns else F.lit(None).cast("string")).alias(c)
        for c in catalog.ORDERS_SCHEMA.names
    ]
    path = scratch_path(spark, "raw-orders")
    headers.select(*columns).write.option("header", "true").csv(path)
    return path


ARRAY_ROWS = 10_000


def raw_arrays(rows: DataFrame) -> str:
    """A table as files that hold one JSON array each.

    An array gathers up to ``ARRAY_ROWS`` rows of one task, and every array
    becomes a file of its own in one folder.
    """
    path = scratch_path(rows.sparkSession, "raw-arrays")
    within = F.monotonically_increasing_id() % (1 << 33)
    records = rows.select(
        F.spark_partition_id().alias("task"),
        F.floor(within / ARRAY_ROWS).alias("part"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"),
    )
    arrays = records.groupBy("task", "part").agg(F.array_join(F.collect_list("record"), ",\n").alias("inner"))
    lines = arrays.select(F.concat(F.lit("["), "inner", F.lit("]")))
    lines.write.option("maxRecordsPerFile", 1).text(path)
    return path


_DIRTY_COLUMNS = ("order_id", "customer_id", "order_date", "total_amount", "status")


def _dirty_sql(extra: str = "", where: str = "true") -> str:
    return with_ctes(f"""
    select order_id, customer_id,
           case when not bad_date then cast(order_date as varchar) end as order_date,
           case when not bad_amount and not no_amount
                then cast(total_amount as double) end as total_amount,
           status {extra}
    from dirty where {where}""")


@query(
    "scan_csv_permissive",
    _dirty_sql(
        """, bad_date or bad_amount as is_corrupt,
           case when bad_date and bad_amount then 'order_date,total_amount'
                when bad_date then 'order_date' when bad_amount then 'total_amount' end as bad_fields"""
    ),
)
def scan_csv_permissive(spark, sf):
    rows = scan(spark, spec_of("orders"), raw_orders(spark, sf))
    return rows.select(
        *_DIRTY_COLUMNS,
        F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt"),
        F.col(CORRUPT_FIELDS).alias("bad_fields"),
    )


@query("quarantine_split_clean", _dirty_sql(where="not bad_date and not bad_amount"))
def quarantine_split_clean(spark, sf):
    clean, _ = split_corrupt(scan(spark, spec_of("orders"), raw_orders(spark, sf)))
    return clean.select(*_DIRTY_COLUMNS)


@query("quarantine_split_bad", _dirty_sql(where="bad_date or bad_amount"))
def quarantine_split_bad(spark, sf):
    _, bad = split_corrupt(scan(spark, spec_of("orders"), raw_orders(spark, sf)))
    return bad.select(*_DIRTY_COLUMNS)


@query(
    "quarantine_roundtrip",
    with_ctes("""
    select order_id, customer_id,
           case when bad_date then 'bad-date' else cast(order_date as varchar) end as raw_date,
           case when bad_amount then 'n/a' when not no_amount
                then cast(total_amount as varchar) end as raw_amount
    from dirty where bad_date or bad_amount"""),
)
def quarantine_roundtrip(spark, sf):
    """Rows are quarantined, read back, and their raw text taken apart again."""
    _, bad = split_corrupt(scan(spark, spec_of("orders"), raw_orders(spark, sf)))
    path = scratch_path(spark, "quarantine")
    write_quarantine(bad, path)
    kept = read_quarantine(spark, path, bad.schema)
    fields = F.split(CORRUPT_COLUMN, ",")
    names = catalog.ORDERS_SCHEMA.names
    return kept.select(
        "order_id",
        "customer_id",
        fields[names.index("order_date")].alias("raw_date"),
        F.nullif(fields[names.index("total_amount")], F.lit("")).alias("raw_amount"),
    )


@query(
    "scan_json_multiline",
    with_ctes(f"""
    select customer_id, customer_name, email, {day("date_of_birth")} as date_of_birth, city,
           is_active, loyalty_tier, false as is_corrupt
    from cust"""),
)
def scan_json_multiline(spark, sf):
    """Customers with a field that is not in the schema, from JSON arrays."""
    people = b.customers(spark, sf).withColumn("fetched_at", F.lit("2024-01-01T00:00:00"))
    path = raw_arrays(people)
    spec = spec_of("customers", read_options={"multiLine": "true", "recursiveFileLookup": "true"})
    rows = scan(spark, spec, path)
    return rows.select(
        "customer_id",
        "customer_name",
        "email",
        "date_of_birth",
        "city",
        "is_active",
        "loyalty_tier",
        F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt"),
    )


@query(
    "scan_json_nested",
    with_ctes("select customer_id, customer_name, phone, city, state, pincode from cust"),
)
def scan_json_nested(spark, sf):
    """The same with city and phone inside an address struct and an array."""
    people = b.customers(spark, sf).select(
        "customer_id",
        "customer_name",
        F.array("phone", F.lit("second")).alias("phone"),
        F.struct("city", "state", "pincode").alias("address"),
    )
    spec = spec_of(
        "customers",
        read_options={"multiLine": "true", "recursiveFileLookup": "true"},
        json_paths=catalog.NESTED_CUSTOMER_PATHS,
    )
    rows = scan(spark, spec, raw_arrays(people))
    return rows.select("customer_id", "customer_name", "phone", "city", "state", "pincode")


@query(
    "scan_parquet",
    with_ctes("""
    select product_id, product_name, category, cast(selling_price as double) as selling_price, is_active
    from prod"""),
)
def scan_parquet(spark, sf):
    path = scratch_path(spark, "raw-products")
    b.products(spark, sf).write.parquet(path)
    return scan(spark, spec_of("products"), path).select(
        "product_id", "product_name", "category", "selling_price", "is_active"
    )


def raw_changes(spark: SparkSession, sf: str) -> tuple[TableSpec, str]:
    """The user change feed as headerless CSV, and its declaration."""
    path = scratch_path(spark, "raw-changes")
    b.changes(spark, sf).write.csv(path, timestampFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
    columns = ("user_id", "updated_at", "event_id", "event_type", "value")
    schema = T.StructType(
        [T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())]
    )
    return TableSpec("users", "csv", "user_id", schema, change_columns=columns), path


@query(
    "scan_cdc_csv",
    with_ctes("""
    select op as "_op", user_id, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') as updated_at,
           cast(event_id as varchar) as event_id, event_type, value
    from chg"""),
)
def scan_cdc_csv(spark, sf):
    spec, path = raw_changes(spark, sf)
    return scan(spark, spec, path).select(
        "_op", "user_id", "updated_at", "event_id", "event_type", "value"
    )


@query(
    "lineage_columns",
    with_ctes("""
    select order_id, true as has_load_time, true as from_source from hdr"""),
)
def lineage_columns(spark, sf):
    """Every row of a table loaded from CSV knows when and from which folder."""
    source = raw_orders(spark, sf)
    rows = scan(spark, spec_of("orders"), source).withColumn(LOADED_AT, F.current_timestamp())
    return rows.select(
        "order_id",
        F.col(LOADED_AT).isNotNull().alias("has_load_time"),
        F.contains(F.col(SOURCE_FILE), F.lit(source.rsplit("/", 1)[-1])).alias("from_source"),
    )


# --- sinks --------------------------------------------------------------------


@query(
    "sink_partitioned_roundtrip",
    with_ctes("""
    select order_id, customer_id, status, payment_method, cast(total_amount as double) as total_amount
    from hdr"""),
)
def sink_partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "partitioned")
    write_table(b.order_headers(spark, sf), path, partition_by=("payment_method",))
    return spark.read.parquet(path).select(
        "order_id", "customer_id", "status", "payment_method", "total_amount"
    )


@query(
    "sink_append_vs_overwrite",
    with_ctes("""
    select 'append' as mode, status, count(*) as orders from hdr group by status
    union all
    select 'append', status, count(*) from hdr where order_id % 5 = 0 group by status
    union all
    select 'overwrite', status, count(*) from hdr where order_id % 5 = 0 group by status"""),
)
def sink_append_vs_overwrite(spark, sf):
    """A second, smaller load on top of a first one, in either mode."""
    first = b.order_headers(spark, sf).withColumn("load", F.lit(1))
    second = first.where("order_id % 5 = 0").withColumn("load", F.lit(2))
    results = []
    for mode in ("append", "overwrite"):
        path = scratch_path(spark, mode)
        write_table(first, path, mode="overwrite")
        write_table(second, path, mode=mode)
        written = spark.read.parquet(path).groupBy("load", "status").agg(
            F.count(F.lit(1)).alias("orders")
        )
        results.append(written.select(F.lit(mode).alias("mode"), "status", "orders"))
    return results[0].unionByName(results[1])


@query(
    "sink_dynamic_partition_overwrite",
    with_ctes("""
    select order_id, payment_method,
           case when payment_method = '1-URGENT' then 'rewritten' else status end as status
    from hdr where payment_method <> '1-URGENT' or order_id % 2 = 0"""),
)
def sink_dynamic_partition_overwrite(spark, sf):
    """One partition is replaced by half of its rows; the others stay."""
    path = scratch_path(spark, "dynamic")
    rows = b.order_headers(spark, sf)
    write_table(rows, path, partition_by=("payment_method",))
    update = rows.where("payment_method = '1-URGENT' and order_id % 2 = 0")
    write_table(
        update.withColumn("status", F.lit("rewritten")),
        path,
        partition_by=("payment_method",),
        dynamic_overwrite=True,
    )
    return spark.read.parquet(path).select("order_id", "payment_method", "status")


@query(
    "schema_merge_read",
    with_ctes("""
    select order_id, status, case when order_id % 2 = 1 then payment_method end as payment_method
    from hdr"""),
)
def schema_merge_read(spark, sf):
    """A column that later loads bring along is NULL in earlier ones."""
    path = scratch_path(spark, "merged")
    rows = b.order_headers(spark, sf)
    write_table(rows.where("order_id % 2 = 0").select("order_id", "status"), path, mode="append")
    write_table(
        rows.where("order_id % 2 = 1").select("order_id", "status", "payment_method"),
        path,
        mode="append",
        keep_schema=True,
    )
    return spark.read.option("mergeSchema", "true").parquet(path)


@query(
    "manifest_new_files",
    with_ctes("""
    select status, count(*) as orders, cast(sum(total_amount) as double) as revenue
    from hdr where order_id % 3 = 0 group by status"""),
)
def manifest_new_files(spark, sf):
    """A third of the orders arrives after the first files were processed; only
    the files that hold it are read."""
    path = scratch_path(spark, "arrivals")
    rows = b.order_headers(spark, sf)
    rows.where("order_id % 3 <> 0").write.parquet(path)
    first = spark.read.parquet(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    manifest_path = scratch_path(spark, "manifest")
    manifest_entries(first, SOURCE_FILE).write.parquet(manifest_path)

    rows.where("order_id % 3 = 0").write.mode("append").parquet(path)
    fresh = new_files(list_files(spark, path), spark.read.parquet(manifest_path))
    names = (row.path for row in fresh.select("path").toLocalIterator())
    slices = iter(lambda: list(islice(names, FILES_PER_READ)), [])
    arrived = union_sources([spark.read.parquet(*part) for part in slices])
    return arrived.groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue")
    )


# --- incremental loads ----------------------------------------------------------

_FIRST_MARK = datetime(1998, 1, 1)


def _loaded(spark, sf) -> DataFrame:
    """Order headers whose load time is their order date."""
    return b.order_headers(spark, sf).withColumn(LOADED_AT, F.col("order_date").cast("timestamp"))


@query(
    "incremental_filter",
    with_ctes(f"""
    select order_id, {day("order_date")} as order_date from hdr where order_date > date '1998-01-01'"""),
)
def incremental_filter(spark, sf):
    return since(_loaded(spark, sf), LOADED_AT, _FIRST_MARK).select("order_id", "order_date")


@query(
    "incremental_new_mark",
    with_ctes("select cast(max(order_date) as varchar) || ' 00:00:00.000000' as mark from hdr"),
)
def incremental_new_mark(spark, sf):
    return next_mark(since(_loaded(spark, sf), LOADED_AT, _FIRST_MARK), LOADED_AT)


@query(
    "incremental_two_runs",
    with_ctes("""
    select case when order_date <= date '1998-01-01' then 1::bigint else 2 end as run,
           count(*) as orders, count(distinct order_id) as distinct_orders,
           cast(sum(total_amount) as double) as revenue
    from hdr group by 1"""),
)
def incremental_two_runs(spark, sf):
    """A table is loaded twice, with more rows the second time, and a third
    time without new ones: every row is read exactly once."""
    target, marks = scratch_path(spark, "runs"), scratch_path(spark, "marks")
    everything = _loaded(spark, sf)
    arrived = [everything.where(F.col(LOADED_AT) <= F.lit(_FIRST_MARK)), everything, everything]
    for rows in arrived:
        mark = read_mark(spark, marks, "silver")
        upto = next_mark(since(rows, LOADED_AT, mark), LOADED_AT).collect()[0].mark
        if upto is None:
            continue
        fresh = since(rows, LOADED_AT, mark, upto)
        write_table(fresh, f"{target}/load_batch={batch_label(mark)}", known_non_empty=True)
        store_mark(spark, marks, "silver", upto)
    return (
        spark.read.parquet(target)
        .groupBy(F.when(F.col("load_batch") == "initial", 1).otherwise(2).alias("run"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_distinct("order_id").alias("distinct_orders"),
            F.sum("total_amount").alias("revenue"),
        )
    )


# --- streams --------------------------------------------------------------------


@query(
    "stream_available_now_ingest",
    _dirty_sql(", bad_date or bad_amount as is_corrupt"),
)
def stream_available_now_ingest(spark, sf):
    """CSV files are ingested by a stream, twice; the second run finds nothing."""
    source = raw_orders(spark, sf)
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        ingest_stream(spark, spec_of("orders"), source, target, checkpoint)
    return spark.read.parquet(target).select(
        *_DIRTY_COLUMNS, F.col(CORRUPT_COLUMN).isNotNull().alias("is_corrupt")
    )


@query(
    "stream_cdc_upsert",
    with_ctes("""
    select user_id, event_id, event_type, value
    from (select * from chg qualify row_number() over (
              partition by user_id order by updated_at desc, event_id) = 1)
    where op <> 'D'"""),
)
def stream_cdc_upsert(spark, sf):
    """The change feed arrives out of order in four batches; the state is
    folded once in between."""
    feed = b.changes(spark, sf)
    source = scratch_path(spark, "feed")
    state, checkpoint = scratch_path(spark, "state"), scratch_path(spark, "checkpoint")
    key, op = ["user_id"], "_op"
    for batch in (2, 0, 3, 1):
        feed.where(F.col("event_id") % 4 == batch).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(feed.schema).parquet(source)
        upsert_stream(arriving, state, checkpoint, key, "updated_at")
        if batch == 0:
            compact_state(spark, state, key, "updated_at")
    return read_state(spark, state, key, "updated_at", op).select(
        "user_id", "event_id", "event_type", "value"
    )


# --- layers ---------------------------------------------------------------------


@query("bronze_orders", _dirty_sql(where="not bad_date and not bad_amount"))
def bronze_orders(spark, sf):
    """The whole bronze chain over order files that arrive twice."""
    source = raw_orders(spark, sf)
    header = {"header": "true"}
    spark.read.options(**header).csv(source).write.options(**header).mode("append").csv(f"{source}/again")
    spec = spec_of("orders", gate=replace(catalog.TABLES["orders"].gate, min_rows=100))
    target = scratch_path(spark, "bronze")
    run_bronze(spark, spec, source, target, scratch_path(spark, "quarantine"))
    return bronze_table(spark, spec, target).select(*_DIRTY_COLUMNS)


@_made_once
def raw_tables(spark: SparkSession, sf: str) -> dict[str, str]:
    """The three basic raw tables, clean, in their formats."""
    lines = b.order_lines(spark, sf, shipping=True).select(*catalog.ORDERS_SCHEMA.names)
    paths = {"orders": scratch_path(spark, "orders"), "products": scratch_path(spark, "products")}
    with shuffles_removed(spark):
        lines.write.options(**_RAW_CSV).csv(paths["orders"])
        b.products(spark, sf).write.parquet(paths["products"])
        paths["customers"] = raw_arrays(b.customers(spark, sf))
    return paths


#: Compressed, and in files of a size that one task reads: such a file is not split.
_RAW_CSV = {"header": "true", "compression": "gzip", "maxRecordsPerFile": str(MAX_RECORDS_PER_FILE)}


@query(
    "medallion_end_to_end",
    with_ctes(f"""
    select {day("order_date")} as order_date, count(order_id) as total_orders,
           {total("total_amount")} as total_revenue, {total("grand_total")} as total_revenue_with_gst,
           {mean("total_amount")} as avg_order_value
    from (select * from core_one) group by order_date"""),
)
def medallion_end_to_end(spark, sf):
    """Raw files through bronze, silver and gold; the daily revenue table."""
    paths = raw_tables(spark, sf)
    json = {"multiLine": "true", "recursiveFileLookup": "true"}
    specs = {
        "orders": spec_of("orders", gate=Gate(min_rows=1)),
        "customers": spec_of("customers", read_options=json, gate=Gate(min_rows=1)),
        "products": spec_of("products", gate=Gate(min_rows=1)),
    }
    root = scratch_path(spark, "lake")
    run_medallion(spark, specs, paths, root)
    return spark.read.parquet(f"{root}/gold/core/agg_daily_revenue")


@query(
    "medallion_two_runs",
    with_ctes(f"""
    select {day("order_date")} as order_date, count(order_id) as total_orders,
           {total("total_amount")} as total_revenue, {total("grand_total")} as total_revenue_with_gst,
           {mean("total_amount")} as avg_order_value
    from (select * from core_one) group by order_date"""),
)
def medallion_two_runs(spark, sf):
    """Half of the orders, the same files again, then all orders anew: the
    second run changes nothing and the third has each order once."""
    paths = raw_tables(spark, sf)
    source = scratch_path(spark, "growing")
    everything = spark.read.option("header", "true").csv(paths["orders"])
    everything.where("order_id % 2 = 0").withColumn("quantity", F.lit("1")).write.options(**_RAW_CSV).csv(source)
    specs = {
        "orders": spec_of("orders", gate=Gate(min_rows=1)),
        "customers": spec_of("customers", gate=Gate(min_rows=1)),
        "products": spec_of("products", gate=Gate(min_rows=1)),
    }
    root = scratch_path(spark, "lake")
    paths = {**paths, "orders": source}
    for run in range(3):
        if run == 2:
            everything.write.options(**_RAW_CSV).mode("append").csv(source)
        run_medallion(spark, specs, paths, root, load_mode="incremental")
    return spark.read.parquet(f"{root}/gold/core/agg_daily_revenue")


@query(
    "silver_incremental_retraction",
    with_ctes("""
    select order_id, customer_id, product_id, status, cast(total_amount as double) as total_amount,
           cast(grand_total as double) as grand_total
    from (select * from core_one)"""),
)
def silver_incremental_retraction(spark, sf):
    """Two loads into core silver: of the second, every 7th order is loaded anew and perhaps
    cancelled by then, every 11th customer is no longer active, if not so before, and every 13th product comes back."""
    lines = b.order_lines(spark, sf, shipping=True).drop("updated_at")
    with shuffles_removed(spark):
        parts = slices(lines, "order_id", passes_for(b.table(spark, sf, "lineitem").count(), 3))
        orders = store([dedup_by_key(part, ["order_id"]) for part in parts], scratch_path(spark, "orders"))
    customers, products = b.customers(spark, sf), b.products(spark, sf)
    first, second = (F.lit(t).cast("timestamp") for t in ("2024-01-01", "2024-01-02"))
    again = F.col("order_id") % 7 == 0
    before = orders.withColumns({
        "status": F.when(again, "shipped").otherwise(F.col("status")),
        "total_amount": F.when(again, (F.col("total_amount") + 1).cast(b.MONEY)).otherwise(F.col("total_amount")),
        LOADED_AT: first,
    })
    loads = [
        (
            before,
            customers.withColumn("is_active", F.col("is_active") | (F.col("customer_id") % 11 == 0)),
            products.withColumn("is_active", F.col("is_active") & (F.col("product_id") % 13 != 0)),
        ),
        (orders.withColumn(LOADED_AT, F.when(again, second).otherwise(first)), customers, products),
    ]
    target, marks = scratch_path(spark, "core-silver"), scratch_path(spark, "marks")
    for frames in loads:
        run_silver(spark, *frames, target, load_mode="incremental", marks=marks)
    return silver_table(spark, target).select(
        "order_id", "customer_id", "product_id", "status", "total_amount", "grand_total"
    )
