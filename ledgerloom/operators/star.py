"""Star schema: facts, dimensions, calendar and the standard aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import day_attributes
from ledgerloom.functions.money import exact_mean
from ledgerloom.operators.dedup import dedup_by_key, distinct_values, latest_per_key, orderable
from ledgerloom.specs import DimensionSpec, MartSpec


def fact(silver: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Projection of enriched orders."""
    return silver.select(*columns)


def attributes(silver: DataFrame, spec: DimensionSpec) -> DataFrame:
    """The different rows of a dimension's attributes.

    Most orders repeat the attributes of their key: these go before rows are sorted for the latest.
    """
    rows = silver.select(
        *[F.col(source).alias(name) for name, source in spec.attributes.items()]
    )
    return rows.distinct() if all(orderable(f.dataType) for f in rows.schema.fields) else rows


def dimension(silver: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row per key with the declared attributes, the latest if ordered."""
    return latest_attributes(attributes(silver, spec), spec)


def latest_attributes(rows: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row per key of a dimension's ``attributes``."""
    if spec.order_by is None:
        return dedup_by_key(rows, [spec.key])
    return latest_per_key(rows, [spec.key], spec.order_by)


def date_dimension(silver: DataFrame, column: str = "order_date") -> DataFrame:
    """Calendar attributes of the days that occur in the data."""
    return distinct_values(silver, column).select(*day_attributes(F.col(column)))


def calendar_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Calendar attributes of every day between two date columns of one row."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))
    return days.select(*day_attributes(F.col("date")))


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Calendar attributes of every day from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar_between(bounds, "start", "end")


def city_orders(orders: DataFrame) -> DataFrame:
    """Orders, customers and revenue per customer city, highest revenue first.

    ``orders`` has the customer's ``city`` on every order, one city per
    customer. Orders are summed per customer first, so a city's customers are
    counted without a shuffle of their own, and no table is read twice.
    """
    return (
        _order_sums(orders, "customer_id", "city")
        .where("customer_id is not null")
        .groupBy("city")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.count(F.lit(1)).alias("unique_customers"),
            F.sum("amount").alias("total_revenue"),
            exact_mean(F.sum("amount"), F.sum("amounts")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def product_sales(orders: DataFrame) -> DataFrame:
    """Orders and revenue per product, highest revenue first, from orders with
    their product's name and category."""
    return (
        _order_sums(orders, "product_id", "product_name", "category")
        .where("product_id is not null")
        .groupBy("product_id", "product_name", "category")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("amount").alias("total_revenue"),
            exact_mean(F.sum("amount"), F.sum("amounts")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def _order_sums(orders: DataFrame, *keys: str) -> DataFrame:
    return orders.groupBy(*keys).agg(
        F.count("order_id").alias("orders"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("amounts"),
    )


def build_mart(df: DataFrame, spec: MartSpec) -> DataFrame:
    """The declared measures at the declared grain."""
    return df.groupBy(*spec.grain).agg(*[F.expr(e).alias(name) for name, e in spec.metrics.items()])


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row has; NULL is no key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where((F.col("rows") > 1) & F.col(key).isNotNull())
