"""Business rules on joined orders: filters and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.calendar import age_in_years
from ledgerloom.functions.money import GST_RATE, gross, gst
from ledgerloom.operators.joins import join_chain
from ledgerloom.specs import LINEAGE_COLUMNS, JoinSpec


def not_cancelled(df: DataFrame, value: str = "cancelled", *, normalise: bool = False) -> DataFrame:
    """Orders whose status is set and is not ``value``.

    The comparison is exact; ``normalise`` ignores case and surrounding blanks.
    """
    status = F.lower(F.trim("status")) if normalise else F.col("status")
    return df.where(status != value)


def active_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows for which every one of the given flags that exists is true."""
    for column in columns:
        if column in df.columns:
            df = df.where(F.col(column))
    return df


def drop_lineage(df: DataFrame) -> DataFrame:
    """Without the columns that describe how a row was loaded."""
    return df.drop(*LINEAGE_COLUMNS)


def add_tax(df: DataFrame, rate: Decimal = GST_RATE) -> DataFrame:
    """gst_amount and grand_total of total_amount."""
    return df.withColumn("gst_amount", gst(F.col("total_amount"), rate)).withColumn(
        "grand_total", gross(F.col("total_amount"), F.col("gst_amount"))
    )


def derive(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add ``{name: SQL expression}`` in order; later ones may use earlier ones."""
    for name, expression in columns.items():
        df = df.withColumn(name, F.expr(expression))
    return df


def add_customer_age(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """customer_age on a given day, today by default."""
    day = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return df.withColumn("customer_age", age_in_years(F.col("date_of_birth"), day))


def prefixed(prefix: str, *columns: str) -> dict[str, str]:
    """Rename mapping that puts an entity's name before the given columns."""
    return {c: f"{prefix}_{c}" for c in columns}


#: Columns that several entities have; each side gets its own name in a join.
SHARED_COLUMNS = ("is_active", "created_at", "updated_at")


def enrich_inner(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with the columns of their customer and product; orders that lack
    either are left out. Shared columns become customer_* and product_*.
    """
    return join_chain(
        {
            "orders": drop_lineage(orders),
            "customers": drop_lineage(customers),
            "products": drop_lineage(products),
        },
        [
            JoinSpec(
                "customers",
                "customer_id",
                "customer_id",
                "inner",
                left="orders",
                rename=prefixed("customer", *SHARED_COLUMNS),
            ),
            JoinSpec(
                "products",
                "product_id",
                "product_id",
                "inner",
                rename=prefixed("product", *SHARED_COLUMNS),
            ),
        ],
    )
