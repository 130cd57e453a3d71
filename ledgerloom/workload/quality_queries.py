"""Schema checks, the quality gate and change feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import catalog
from ledgerloom.operators.cdc import current_state, decode_ops, drop_deletes, op_distribution
from ledgerloom.operators.joins import join_lookup
from ledgerloom.operators.quality import null_profile, quality_verdict, step_counts
from ledgerloom.operators.schema import conform, drift_report
from ledgerloom.specs import CORRUPT_COLUMN, OP_COLUMN, Gate, struct_from_columns
from ledgerloom.workload import bindings as b
from ledgerloom.workload.registry import query
from ledgerloom.workload.sql import with_ctes

_TEXT_SCHEMA = struct_from_columns(
    [
        {"name": "order_id", "type": "long"},
        {"name": "order_date", "type": "date"},
        {"name": "total_amount", "type": "decimal(18,2)"},
        {"name": "coupon", "type": "string"},
    ]
)


def _text_orders(spark, sf):
    """Order headers as text, every 50th with an unreadable date and every 70th
    with an unreadable amount, and a column that is not in the schema."""
    key = F.col("o_orderkey")
    return b.table(spark, sf, "orders").select(
        key.cast("string").alias("order_id"),
        F.when(key % 50 == 0, "bad-date")
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("order_date"),
        F.when(key % 70 == 0, "n/a")
        .otherwise(F.col("o_totalprice").cast(b.MONEY).cast("string"))
        .alias("total_amount"),
        F.when(key % 4 == 0, F.col("o_orderpriority")).alias("priority"),
    )


@query(
    "schema_conform",
    """
    select o_orderkey as order_id,
           case when o_orderkey % 50 <> 0 then cast(cast(o_orderdate as date) as varchar) end as order_date,
           case when o_orderkey % 70 <> 0
                then cast(cast(o_totalprice as decimal(18,2)) as double) end as total_amount,
           case when o_orderkey % 4 = 0 then o_orderpriority end as priority,
           cast(null as varchar) as coupon
    from orders""",
)
def schema_conform(spark, sf):
    return conform(_text_orders(spark, sf), _TEXT_SCHEMA)


@query(
    "schema_drift_report",
    """
    select 'priority' as "column", 'new' as kind, count(*) filter (o_orderkey % 4 = 0) as filled_rows
    from orders
    union all
    select 'coupon', 'missing', 0""",
)
def schema_drift_report(spark, sf):
    return drift_report(_text_orders(spark, sf), _TEXT_SCHEMA)


def _gappy_orders(spark, sf):
    """Order headers with missing values and rows marked as malformed."""
    key = F.col("order_id")
    return b.order_headers(spark, sf).select(
        "order_id",
        F.when(key % 11 != 0, F.col("customer_id")).alias("customer_id"),
        F.when(key % 30 != 0, F.col("total_amount")).alias("total_amount"),
        F.when(key % 9 != 0, F.col("status")).alias("status"),
        F.when(key % 40 == 7, "raw text").alias(CORRUPT_COLUMN),
    )


_GAPPY_SQL = """
    gappy as (
        select o_orderkey as order_id, o_orderkey % 40 = 7 as bad,
               o_orderkey % 11 = 0 as no_customer, o_orderkey % 30 = 0 as no_amount,
               o_orderkey % 9 = 0 as no_status
        from orders)"""


@query(
    "null_profile",
    f"""
    with {_GAPPY_SQL}
    select "column", cast(null_count as bigint) as null_count,
           round(null_count / n * 100, 2) as null_percent
    from (
        select 'order_id' as "column", 0 as null_count, count(*) as n from gappy
        union all select 'customer_id', count(*) filter (no_customer), count(*) from gappy
        union all select 'total_amount', count(*) filter (no_amount), count(*) from gappy
        union all select 'status', count(*) filter (no_status), count(*) from gappy)""",
)
def null_profile_query(spark, sf):
    return null_profile(
        _gappy_orders(spark, sf), ["order_id", "customer_id", "total_amount", "status"]
    )


@query(
    "quality_gate_verdict",
    f"""
    with {_GAPPY_SQL},
    m as (
        select count(*) filter (not bad) as good, count(*) filter (bad) as bad,
               count(*) filter (not bad and no_customer) as no_customer,
               count(*) filter (not bad and no_amount) as no_amount,
               count(*) filter (not bad and no_status) as no_status
        from gappy)
    select "check", cast(observed as double) as observed, cast(lim as double) as "limit",
           case when failed is null then 'skipped' when failed then 'fail' else 'pass' end as status
    from (
        select 'quarantine_percent' as "check", bad / (good + bad) * 100 as observed, 20 as lim,
               bad / (good + bad) * 100 > 20 as failed from m
        union all select 'zero_rows', good, 1, good = 0 from m
        union all select 'min_rows', good, 1000, good < 1000 from m
        union all select 'null_order_id', 0, 0, false from m
        union all select 'null_customer_id', no_customer / good * 100, 0, no_customer > 0 from m
        union all select 'null_total_amount', no_amount / good * 100, 5, no_amount / good * 100 > 5 from m
        union all select 'null_status', no_status / good * 100, 10, no_status / good * 100 > 10 from m
        union all select 'null_price', null, 0, null from m)""",
)
def quality_gate_verdict(spark, sf):
    gate = Gate({**catalog.ORDER_LIMITS, "price": 0}, min_rows=1000)
    return quality_verdict(_gappy_orders(spark, sf), gate)


@query(
    "quality_quarantine_pct",
    """
    select count(*) filter (bad) / count(*) * 100 as observed, cast(2 as double) as "limit",
           case when count(*) filter (bad) / count(*) * 100 > 2 then 'fail' else 'pass' end as status
    from (select o_orderkey % 40 = 7 as bad from orders)""",
)
def quality_quarantine_pct(spark, sf):
    verdict = quality_verdict(_gappy_orders(spark, sf), Gate(max_quarantine_percent=2))
    return verdict.where(F.col("check") == "quarantine_percent").drop("check")


@query(
    "step_metrics",
    with_ctes("""
    select 'read' as step, count(*) as "rows" from hdr
    union all select 'not_cancelled', count(*) from hdr where status <> 'cancelled'
    union all select 'active', count(*) from hdr join cust using (customer_id)
              where status <> 'cancelled' and is_active"""),
)
def step_metrics(spark, sf):
    """Orders left after each step of the business rules, in one pass."""
    joined = join_lookup(
        b.order_headers(spark, sf), b.customers(spark, sf), "customer_id", how="left"
    )
    steps = {
        "read": None,
        "not_cancelled": F.col("status") != "cancelled",
        "active": F.col("is_active"),
    }
    return step_counts(joined, steps)


@query("cdc_op_distribution", with_ctes('select op as "_op", count(*) as changes from chg group by op'))
def cdc_op_distribution(spark, sf):
    return op_distribution(b.changes(spark, sf))


@query(
    "cdc_drop_deletes",
    with_ctes("""select op as "_op", event_id, user_id from chg where op <> 'D'"""),
)
def cdc_drop_deletes(spark, sf):
    return drop_deletes(b.changes(spark, sf)).select("_op", "event_id", "user_id")


@query(
    "cdc_decode_ops",
    with_ctes("""
    select event_id, user_id,
           case op when 'I' then 'insert' when 'U' then 'update' else 'unknown' end as dms_operation
    from chg"""),
)
def cdc_decode_ops(spark, sf):
    return decode_ops(b.changes(spark, sf)).select("event_id", "user_id", OP_COLUMN)


_STATE_SQL = """
    select user_id, event_id, event_type, value,
           strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') as updated_at
    from (select * from chg {before} qualify row_number() over (
              partition by user_id order by updated_at desc, event_id) = 1)
    {after}"""
_STATE_COLUMNS = ("user_id", "event_id", "event_type", "value", "updated_at")


@query("cdc_state_reference", with_ctes(_STATE_SQL.format(before="where op <> 'D'", after="")))
def cdc_state_reference(spark, sf):
    state = current_state(
        b.changes(spark, sf), ["user_id"], "updated_at", deletes="records", tie_break=["event_id"]
    )
    return state.select(*_STATE_COLUMNS)


@query("cdc_state_latest", with_ctes(_STATE_SQL.format(before="", after="where op <> 'D'")))
def cdc_state_latest(spark, sf):
    state = current_state(b.changes(spark, sf), ["user_id"], "updated_at", tie_break=["event_id"])
    return state.select(*_STATE_COLUMNS)
