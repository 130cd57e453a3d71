"""The retail entities, read from the benchmark tables.

An order is a line item with the header of its order. Attributes the tables
lack are derived from keys by rules that ``workload.sql`` states again for the
oracle. Keys are bigint throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import join_lookup
from ledgerloom.specs import RAW_OP_COLUMN

MONEY = "decimal(18,2)"
STATUS = "case o_orderstatus when 'F' then 'completed' when 'O' then 'shipped' else 'cancelled' end"

#: Declared so that opening a table does not start a job to look at its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str, *, shipping: bool = False) -> DataFrame:
    """Orders at line grain; ``shipping`` adds city and state of the customer."""
    headers = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    joined = join_lookup(lines, headers, "l_orderkey", "o_orderkey")
    if shipping:
        home = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        joined = join_lookup(joined, home, "o_custkey", "c_custkey")
        joined = joined.join(_places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.selectExpr(
        "l_orderkey * 8 + l_linenumber as order_id",
        "o_custkey as customer_id",
        "l_partkey as product_id",
        "cast(o_orderdate as date) as order_date",
        "cast(l_quantity as int) as quantity",
        f"cast((cast(cast(l_extendedprice as {MONEY}) * 100 as bigint)"
        f" div cast(l_quantity as bigint)) / 100 as {MONEY}) as unit_price",
        f"cast(round(cast(l_extendedprice as {MONEY}) * cast(l_discount as decimal(4,2)), 2)"
        f" as {MONEY}) as discount_amount",
        f"cast(l_extendedprice as {MONEY}) as total_amount",
        f"{STATUS} as status",
        "o_orderpriority as payment_method",
        "case l_linestatus when 'F' then 'paid' else 'pending' end as payment_status",
        *(["n_name as shipping_city", "r_name as shipping_state"] if shipping else []),
        "lpad(cast(o_custkey % 1000000 as string), 6, '0') as shipping_pincode",
        "case l_linenumber % 3 when 0 then 'web' when 1 then 'app' else 'store' end as order_source",
        "cast(l_shipdate as timestamp) as updated_at",
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers alone, for operators that need no product."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        "cast(o_orderdate as date) as order_date",
        f"cast(o_totalprice as {MONEY}) as total_amount",
        f"{STATUS} as status",
        "o_orderpriority as payment_method",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "customer").join(
        _places(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.selectExpr(
        "c_custkey as customer_id",
        "c_name as customer_name",
        "case when c_custkey % 10 <> 0 then concat(lower(c_name), '@example.com') end as email",
        "lpad(cast(c_custkey as string), 10, '9') as phone",
        "case when c_custkey % 2 = 0 then 'F' else 'M' end as gender",
        "date_add(date '1960-01-01', cast(c_custkey % 15000 as int)) as date_of_birth",
        "n_name as city",
        "r_name as state",
        "lpad(cast(c_custkey % 1000000 as string), 6, '0') as pincode",
        "date_add(date '1990-01-01', cast(c_custkey % 5000 as int)) as registered_date",
        "case when c_custkey % 3 = 0 then 'web' else 'app' end as registration_source",
        "case when c_custkey % 4 = 0 then 'card' else 'upi' end as preferred_payment",
        "c_acctbal >= 0 as is_active",
        "c_custkey % 5 <> 0 as is_verified",
        "c_mktsegment as loyalty_tier",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        "p_brand as brand",
        "p_type as category",
        "concat_ws('/', p_type, p_brand) as sub_category",
        f"cast(p_retailprice as {MONEY}) as mrp",
        f"{_discounted('p_retailprice')} as selling_price",
        "cast(p_partkey % 4 * 5 as int) as discount_percentage",
        "cast(p_partkey % 500 as int) as stock_quantity",
        f"cast(p_size as {MONEY}) as weight_kg",
        f"cast(p_partkey % 5 + 1 as {MONEY}) as avg_rating",
        "cast(p_partkey % 1000 as int) as review_count",
        "p_size > 5 as is_active",
        "date_add(date '1990-01-01', cast(p_partkey % 5000 as int)) as launch_date",
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily price snapshots per product; the later one is 1 dearer."""
    snapshots = table(spark, sf_dir, "part").withColumn(
        "snapshot", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    return snapshots.selectExpr(
        "p_partkey as product_id",
        "p_name as product_name",
        "p_type as category",
        f"cast(cast(p_retailprice as {MONEY}) + snapshot as {MONEY}) as base_price",
        "cast(p_partkey % 4 * 5 as int) as discount_percentage",
        f"{_discounted('p_retailprice + snapshot')} as final_price",
        "'INR' as currency",
        "date_add(date '2024-01-01', snapshot) as price_date",
    )


def _discounted(price: str) -> str:
    return (
        f"cast(round(cast({price} as {MONEY}) * cast(100 - p_partkey % 4 * 5 as decimal(5,2))"
        f" * cast(0.01 as decimal(3,2)), 2) as {MONEY})"
    )


def two_sources(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """An entity as a plain table without change times and as a change feed.

    Keys divisible by 3 are in the feed, those divisible by 6 in both.
    """
    plain = df.where(f"{key} % 3 <> 0 or {key} % 6 = 0").drop("updated_at")
    stamp = f"timestamp_seconds({key} % 1000000)"
    feed = df.where(f"{key} % 3 = 0").drop("updated_at").selectExpr(
        "*", f"{stamp} as created_at", f"{stamp} + interval 1 day as updated_at"
    )
    return plain, feed


def both_sources(df: DataFrame, key: str) -> DataFrame:
    """The rows of the two sources of ``two_sources`` in one frame, with ``from_feed``; a row in both comes twice.

    What made ``df`` runs once instead of once per source, and both versions of a row are in
    one task, where the older one goes before any shuffle.
    """
    feed = f"case when {key} % 6 = 0 then array(false, true) when {key} % 3 = 0 then array(true) when {key} % 3 <> 0 then array(false) end"
    stamp = f"case when from_feed then timestamp_seconds({key} % 1000000) end"
    return df.drop("updated_at").selectExpr("*", f"explode({feed}) as from_feed").selectExpr(
        "*", f"{stamp} as created_at", f"{stamp} + interval 1 day as updated_at"
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change feed of users, from the events."""
    return table(spark, sf_dir, "events").selectExpr(
        f"case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as {RAW_OP_COLUMN}",
        "user_id",
        "cast(ts as timestamp) as updated_at",
        "event_id",
        "event_type",
        "value",
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region: two tables of fixed size."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )
