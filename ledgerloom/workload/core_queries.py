"""Joins, business rules and the small star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators.dedup import dedup_by_key, latest_per_key
from ledgerloom.operators.enrich import (
    active_only,
    add_customer_age,
    add_tax,
    derive,
    enrich_inner,
    not_cancelled,
)
from ledgerloom.operators.joins import join_chain, join_lookup
from ledgerloom.operators.star import (
    calendar_between,
    city_orders,
    date_dimension,
    dimension,
    fact,
    product_sales,
)
from ledgerloom.plans.gold import daily_revenue
from ledgerloom.plans.silver import silver_core
from ledgerloom.specs import JoinSpec
from ledgerloom.workload import bindings as b
from ledgerloom.workload.registry import query
from ledgerloom.workload.sql import AS_OF, day, mean, total, with_ctes


def core(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched orders of the small star schema."""
    return silver_core(b.order_lines(spark, sf), b.customers(spark, sf), b.products(spark, sf))


@query(
    "filter_not_cancelled",
    with_ctes(f"""
    select order_id, customer_id, {day("order_date")} as order_date, status from hdr
    where status <> 'cancelled'"""),
)
def filter_not_cancelled(spark, sf):
    return not_cancelled(b.order_headers(spark, sf)).select(
        "order_id", "customer_id", "order_date", "status"
    )


@query(
    "filter_active",
    with_ctes("select customer_id, customer_name, city from cust where is_active"),
)
def filter_active(spark, sf):
    return active_only(b.customers(spark, sf), ["is_active"]).select(
        "customer_id", "customer_name", "city"
    )


@query(
    "join_orders_customers",
    with_ctes("""
    select order_id, customer_id, customer_name, city, loyalty_tier,
           cast(total_amount as double) as total_amount
    from hdr join cust using (customer_id)"""),
)
def join_orders_customers(spark, sf):
    joined = join_lookup(b.order_headers(spark, sf), b.customers(spark, sf), "customer_id")
    return joined.select(
        "order_id", "customer_id", "customer_name", "city", "loyalty_tier", "total_amount"
    )


@query(
    "enrich_inner",
    with_ctes("""
    select order_id, customer_id, product_id, customer_name, city, product_name, category, status,
           cust.is_active as customer_is_active, prod.is_active as product_is_active,
           cast(total_amount as double) as total_amount
    from ord join cust using (customer_id) join prod using (product_id)"""),
)
def enrich_inner_query(spark, sf):
    joined = enrich_inner(b.order_lines(spark, sf), b.customers(spark, sf), b.products(spark, sf))
    return joined.select(
        "order_id",
        "customer_id",
        "product_id",
        "customer_name",
        "city",
        "product_name",
        "category",
        "status",
        "customer_is_active",
        "product_is_active",
        "total_amount",
    )


@query(
    "join_chain",
    with_ctes("""
    select order_id, customer_name, product_name, category
    from ord join cust using (customer_id) left join (select * from prod where is_active) using (product_id)"""),
)
def join_chain_query(spark, sf):
    frames = {
        "orders": b.order_lines(spark, sf),
        "customers": b.customers(spark, sf),
        "active_products": active_only(b.products(spark, sf), ["is_active"]).drop("is_active"),
    }
    joins = [
        JoinSpec("customers", "customer_id", "customer_id", "inner", left="orders"),
        JoinSpec("active_products", "product_id", "product_id", "left"),
    ]
    return join_chain(frames, joins).select(
        "order_id", "customer_name", "product_name", "category"
    )


@query(
    "derive_gst",
    with_ctes("""
    select order_id, product_id, cast(total_amount as double) as total_amount,
           cast(gst_amount as double) as gst_amount, cast(grand_total as double) as grand_total
    from core"""),
)
def derive_gst(spark, sf):
    return core(spark, sf).select(
        "order_id", "product_id", "total_amount", "gst_amount", "grand_total"
    )


@query(
    "derive_order_columns",
    with_ctes("""
    select order_id, product_id,
           cast(total_amount - discount_amount as double) as net_amount,
           cast(year(order_date) as bigint) as order_year,
           cast(month(order_date) as bigint) as order_month,
           cast(dayofweek(order_date) + 1 as bigint) as order_day_of_week,
           coalesce(total_amount >= 5000, false) as is_high_value
    from ord"""),
)
def derive_order_columns(spark, sf):
    derived = derive(b.order_lines(spark, sf), catalog.DERIVED_COLUMNS)
    return derived.select("order_id", "product_id", *catalog.DERIVED_COLUMNS)


@query(
    "derive_customer_age",
    with_ctes(f"""
    select customer_id,
           cast(floor(date_diff('day', date_of_birth, date '{AS_OF}') / 365) as bigint) as customer_age
    from cust"""),
)
def derive_customer_age(spark, sf):
    return add_customer_age(b.customers(spark, sf), AS_OF).select("customer_id", "customer_age")


@query(
    "derive_generic",
    with_ctes("""
    select order_id, cast(total_amount as double) * 2 as doubled,
           cast(total_amount as double) * 2 + 1 as doubled_plus,
           upper(status) as loud_status
    from hdr"""),
)
def derive_generic(spark, sf):
    columns = {
        "doubled": "cast(total_amount as double) * 2",
        "doubled_plus": "doubled + 1",
        "loud_status": "upper(status)",
    }
    return derive(b.order_headers(spark, sf), columns).select("order_id", *columns)


@query(
    "dedup_by_key",
    """
    select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, l_extendedprice
    from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1""",
)
def dedup_by_key_query(spark, sf):
    lines = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    return dedup_by_key(lines, ["l_orderkey", "l_linenumber"]).drop("l_quantity")


@query(
    "dedup_latest",
    """
    select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, l_extendedprice,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') as l_shipdate
    from lineitem
    qualify row_number() over (
        partition by l_orderkey, l_linenumber
        order by l_shipdate desc nulls last, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def dedup_latest(spark, sf):
    lines = b.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "fact_orders_core",
    with_ctes(f"""
    select order_id, customer_id, product_id, {day("order_date")} as order_date,
           cast(total_amount as double) as total_amount, cast(grand_total as double) as grand_total
    from core"""),
)
def fact_orders_core(spark, sf):
    return fact(core(spark, sf), catalog.FACT_CORE)


@query(
    "dim_customers_core",
    with_ctes(f"""
    select distinct customer_id, customer_name, city, {day("registered_date")} as registered_date
    from core"""),
)
def dim_customers_core(spark, sf):
    return dimension(core(spark, sf), catalog.DIM_CUSTOMERS_CORE)


@query(
    "dim_products_core",
    with_ctes("""
    select distinct product_id, product_name, category, cast(selling_price as double) as price
    from core"""),
)
def dim_products_core(spark, sf):
    return dimension(core(spark, sf), catalog.DIM_PRODUCTS_CORE)


_DAY_SQL = f"""
    select {day("d")} as date, cast(dayofweek(d) + 1 as bigint) as day_of_week,
           dayname(d) as day_name, cast(month(d) as bigint) as month, monthname(d) as month_name,
           cast(quarter(d) as bigint) as quarter, cast(year(d) as bigint) as year,
           dayofweek(d) in (0, 6) as is_weekend"""


@query("dim_date_from_data", with_ctes(f"{_DAY_SQL} from (select distinct order_date as d from core)"))
def dim_date_from_data(spark, sf):
    return date_dimension(core(spark, sf))


@query(
    "dim_date_generated",
    f"""{_DAY_SQL}
    from (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d
          from orders)""",
)
def dim_date_generated(spark, sf):
    days = F.col("o_orderdate").cast("date")
    bounds = b.table(spark, sf, "orders").agg(
        F.min(days).alias("start"), F.max(days).alias("end")
    )
    return calendar_between(bounds, "start", "end")


@query(
    "agg_daily_revenue",
    with_ctes(f"""
    select {day("order_date")} as order_date, count(order_id) as total_orders,
           {total("total_amount")} as total_revenue, {total("grand_total")} as total_revenue_with_gst,
           {mean("total_amount")} as avg_order_value
    from core group by order_date"""),
)
def agg_daily_revenue(spark, sf):
    return daily_revenue(fact(core(spark, sf), catalog.FACT_CORE))


@query(
    "agg_city_orders",
    with_ctes(f"""
    select city, count(order_id) as total_orders, count(distinct customer_id) as unique_customers,
           {total("total_amount")} as total_revenue, {mean("total_amount")} as avg_order_value
    from core group by city"""),
)
def agg_city_orders(spark, sf):
    return city_orders(core(spark, sf))


@query(
    "agg_product_sales",
    with_ctes(f"""
    select product_id, product_name, category, count(order_id) as total_orders,
           {total("total_amount")} as total_revenue, {mean("total_amount")} as avg_order_value
    from core group by product_id, product_name, category"""),
)
def agg_product_sales(spark, sf):
    return product_sales(core(spark, sf))
