"""The bindings once more, as SQL text for the oracle.

Each constant is a common table expression; ``with_ctes`` puts the ones a query
names in front of it.
"""

from __future__ import annotations

import re

_STATUS = "case o_orderstatus when 'F' then 'completed' when 'O' then 'shipped' else 'cancelled' end"

ORDER_COLUMNS = (
    "order_id customer_id product_id order_date quantity unit_price discount_amount total_amount "
    "status payment_method payment_status shipping_city shipping_state shipping_pincode order_source"
).split()

CTES = {
    "ord": f"""
        select l_orderkey * 8 + l_linenumber as order_id,
               o_custkey as customer_id,
               l_partkey as product_id,
               cast(o_orderdate as date) as order_date,
               cast(l_quantity as integer) as quantity,
               cast((cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint)
                     // cast(l_quantity as bigint)) / 100 as decimal(18,2)) as unit_price,
               cast(round(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(4,2)), 2)
                    as decimal(18,2)) as discount_amount,
               cast(l_extendedprice as decimal(18,2)) as total_amount,
               {_STATUS} as status,
               o_orderpriority as payment_method,
               case l_linestatus when 'F' then 'paid' else 'pending' end as payment_status,
               n_name as shipping_city,
               r_name as shipping_state,
               lpad(cast(o_custkey % 1000000 as varchar), 6, '0') as shipping_pincode,
               case l_linenumber % 3 when 0 then 'web' when 1 then 'app' else 'store' end as order_source,
               l_shipdate as updated_at
        from lineitem
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "hdr": f"""
        select o_orderkey as order_id,
               o_custkey as customer_id,
               cast(o_orderdate as date) as order_date,
               cast(o_totalprice as decimal(18,2)) as total_amount,
               {_STATUS} as status,
               o_orderpriority as payment_method
        from orders""",
    # Order headers with the flaws that the raw order file is given.
    "dirty": """
        select *, order_id % 50 = 0 as bad_date, order_id % 90 = 0 as bad_amount,
               order_id % 90 <> 0 and order_id % 70 = 0 as no_amount
        from hdr""",
    "cust": """
        select c_custkey as customer_id,
               c_name as customer_name,
               case when c_custkey % 10 <> 0 then lower(c_name) || '@example.com' end as email,
               lpad(cast(c_custkey as varchar), 10, '9') as phone,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
               date '1960-01-01' + cast(c_custkey % 15000 as integer) as date_of_birth,
               n_name as city,
               r_name as state,
               lpad(cast(c_custkey % 1000000 as varchar), 6, '0') as pincode,
               date '1990-01-01' + cast(c_custkey % 5000 as integer) as registered_date,
               case when c_custkey % 3 = 0 then 'web' else 'app' end as registration_source,
               case when c_custkey % 4 = 0 then 'card' else 'upi' end as preferred_payment,
               c_acctbal >= 0 as is_active,
               c_custkey % 5 <> 0 as is_verified,
               c_mktsegment as loyalty_tier
        from customer
        join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "prod": """
        select p_partkey as product_id,
               p_name as product_name,
               p_brand as brand,
               p_type as category,
               p_type || '/' || p_brand as sub_category,
               cast(p_retailprice as decimal(18,2)) as mrp,
               cast(round(cast(p_retailprice as decimal(18,2))
                    * cast(100 - p_partkey % 4 * 5 as decimal(5,2)) * cast(0.01 as decimal(3,2)), 2)
                    as decimal(18,2)) as selling_price,
               p_partkey % 4 * 5 as discount_percentage,
               p_partkey % 500 as stock_quantity,
               cast(p_size as decimal(18,2)) as weight_kg,
               cast(p_partkey % 5 + 1 as decimal(18,2)) as avg_rating,
               p_partkey % 1000 as review_count,
               p_size > 5 as is_active,
               date '1990-01-01' + cast(p_partkey % 5000 as integer) as launch_date
        from part""",
    "price_feed": """
        select p_partkey as product_id,
               p_name as product_name,
               p_type as category,
               cast(p_retailprice as decimal(18,2)) + snapshot as base_price,
               p_partkey % 4 * 5 as discount_percentage,
               cast(round(cast(cast(p_retailprice as decimal(18,2)) + snapshot as decimal(18,2))
                    * cast(100 - p_partkey % 4 * 5 as decimal(5,2)) * cast(0.01 as decimal(3,2)), 2)
                    as decimal(18,2)) as final_price,
               date '2024-01-01' + snapshot as price_date
        from part, (values (0), (1)) as s(snapshot)""",
    "chg": """
        select case event_type when 'signup' then 'I' when 'error' then 'D' else 'U' end as op,
               user_id, ts as updated_at, event_id, event_type, value
        from events""",
}


def _latest(source: str, key: str, order: str, columns) -> str:
    ties = ", ".join(f"{c} nulls last" for c in columns if c != key)
    return (
        f"select * from {source} qualify row_number() over "
        f"(partition by {key} order by {order}, {ties}) = 1"
    )


def _two_sources(source: str, key: str, feed_changes: str = "") -> str:
    """Both sides of an entity, with the change time of the feed and its rank."""
    return f"""
        select *, null::bigint as changed, 0 as source_rank from {source}
        where {key} % 3 <> 0 or {key} % 6 = 0
        union all
        select * {feed_changes}, {key} % 1000000 as changed, 1 as source_rank from {source}
        where {key} % 3 = 0"""


_NEWEST = "changed desc nulls last, source_rank desc"
#: Orders from the feed carry this status.
FEED_STATUS = "returned"

CTES |= {
    "ord2": _two_sources("ord", "order_id", f"replace ('{FEED_STATUS}' as status)"),
    "cust2": _two_sources("cust", "customer_id", "replace ('gold' as loyalty_tier)"),
    "prod2": _two_sources("prod", "product_id", "replace ('feed' as brand)"),
    "ord_one": _latest("ord", "order_id", "1", ORDER_COLUMNS),
    "all_ord": _latest(
        "ord2",
        "order_id",
        _NEWEST,
        ["order_id", "total_amount"],
    ),
    "all_cust": _latest("cust2", "customer_id", _NEWEST, ["customer_id"] + ["customer_name"]),
    "all_prod": _latest("prod2", "product_id", _NEWEST, ["product_id"] + ["product_name"]),
    # Enriched orders of the small star schema.
    "core": """
        select *, cast(round(total_amount + gst_amount, 2) as decimal(18,2)) as grand_total
        from (
            select ord.*, cust.customer_name, cust.city, cust.registered_date,
                   prod.product_name, prod.category, prod.selling_price,
                   cast(round(total_amount * cast(0.18 as decimal(2,2)), 2) as decimal(18,2)) as gst_amount
            from ord
            join cust using (customer_id)
            join prod using (product_id)
            where status <> 'cancelled' and cust.is_active and prod.is_active)""",
    # The same from orders of which one row per id was kept at loading.
    "core_one": """
        select *, cast(round(total_amount + gst_amount, 2) as decimal(18,2)) as grand_total
        from (
            select o.*, cast(round(total_amount * cast(0.18 as decimal(2,2)), 2) as decimal(18,2)) as gst_amount
            from ord_one o
            join cust using (customer_id)
            join prod using (product_id)
            where status <> 'cancelled' and cust.is_active and prod.is_active)""",
    # Enriched orders of the wide star schema.
    "wide": """
        select o.*,
               c.* exclude (customer_id, changed, source_rank, is_active),
               c.is_active as customer_is_active,
               p.* exclude (product_id, changed, source_rank, is_active),
               p.is_active as product_is_active,
               r.base_price, r.final_price, r.price_date,
               total_amount - discount_amount as net_amount,
               year(order_date) as order_year,
               month(order_date) as order_month,
               dayofweek(order_date) + 1 as order_day_of_week,
               coalesce(total_amount >= 5000, false) as is_high_value,
               cast(floor(date_diff('day', date_of_birth, date '2024-06-30') / 365) as bigint) as customer_age
        from all_ord o
        left join all_cust c on o.customer_id = c.customer_id
        left join all_prod p on o.product_id = p.product_id
        left join (select * from price_feed qualify
                   row_number() over (partition by product_id order by price_date desc) = 1) r
               on o.product_id = r.product_id""",
}

AS_OF = "2024-06-30"


def with_ctes(sql: str) -> str:
    """``sql`` preceded by the common table expressions it uses, in order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{n} as ({CTES[n]})" for n in CTES if n in needed)
    return f"with {parts}\n{sql.strip()}"


def day(expression: str) -> str:
    return f"cast({expression} as varchar)"


def total(expression: str) -> str:
    """Sum as a double."""
    return f"cast(sum({expression}) as double)"


def mean(expression: str) -> str:
    """Decimal average rounded half-up to six places, in integer arithmetic."""
    cents = f"sum(cast({expression} * 100 as hugeint))"
    n = f"count({expression})"
    return f"cast((2 * 10000 * {cents} + {n}) // (2 * {n}) as double) / 1000000"
