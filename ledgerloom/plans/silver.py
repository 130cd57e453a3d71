"""Silver: bronze tables joined, filtered and enriched."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import CHANGE_TIMES, DERIVED_COLUMNS, DROPPED_COLUMNS, ENRICH_JOINS, UNIONS
from ledgerloom.operators.dedup import known_unique, latest_per_key, union_latest, union_sources
from ledgerloom.operators.enrich import (
    active_only,
    add_customer_age,
    add_tax,
    derive,
    drop_lineage,
    enrich_inner,
    not_cancelled,
)
from ledgerloom.operators.incremental import (
    batch_label,
    changed_keys,
    read_mark,
    row_versions,
    since,
    store_marks,
)
from ledgerloom.operators.joins import join_chain
from ledgerloom.operators.passes import of_groups, one_moment, passes_for, slices, value_groups
from ledgerloom.sources.files import read_if_exists, read_table
from ledgerloom.sources.scratch import discard, names_in, removing_shuffles, scratch_path, store
from ledgerloom.sources.sinks import fold_files, metric, replace_partitions, write_table
from ledgerloom.specs import LOADED_AT, OP_COLUMN, SILVER_LOADED_AT, SOURCE_FILE

PROCESSOR = "silver"
ENRICHED = "silver_enriched"
#: Marks an order that earlier batches have and that silver no longer has.
WITHDRAWN = "silver_withdrawn"
#: How often orders are shuffled, enriched ones also for their wide rows (``operators.passes``).
_CORE_SHUFFLES, _ENRICHED_SHUFFLES = 2, 4


def silver_core(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders of active customers and products that are not cancelled, with tax.

    All joins are inner, so each filter is applied to the table it concerns,
    before any row is shuffled.
    """
    joined = enrich_inner(
        not_cancelled(orders),
        active_only(customers, ["is_active"]),
        active_only(products, ["is_active"]),
    )
    return add_tax(joined)


@removing_shuffles
def run_silver(
    spark: SparkSession,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    target: str,
    *,
    load_mode: str = "full",
    marks: str | None = None,
    fmt: str = "parquet",
) -> bool:
    """Write ``silver_core``; returns False when there was nothing to write.

    The tables have one row per key. An order that is loaded anew comes again in
    a later batch; ``silver_table`` reads its latest version.

    Incremental runs take the orders loaded after the stored mark, and those
    of customers and products that came, went or changed since the last run.
    Orders that no longer belong to silver, because they are cancelled by now or their
    customer or product is not active any more, come as withdrawals: rows with an id and
    ``WITHDRAWN`` only. Each run writes a ``load_batch`` folder named by the run it follows and
    stores the new marks last, so a run that failed half-way is simply repeated. Many orders are
    joined in passes by their id (``operators.passes``).
    """
    now = one_moment()
    if load_mode != "incremental":
        parts = slices(orders, "order_id", passes_for(orders.count(), _CORE_SHUFFLES))
        return write_table([_stamped(silver_core(part, customers, products), now) for part in parts], target, fmt=fmt)
    mark = read_mark(spark, marks, PROCESSOR)
    upto, number = _loaded(orders, mark)
    dimensions = {"customers": ("customer_id", customers), "products": ("product_id", products)}
    seen = SeenRows(spark, marks, PROCESSOR, dimensions)
    changed = seen.changed() if mark is not None else {}
    if upto is None and not changed:
        seen.forget()
        return False
    path, touched = None, orders
    if mark is not None:  # found among the latest versions of all orders; read twice
        path = scratch_path(spark, "touched-orders")
        parts = slices(orders, "order_id", passes_for(number, 1 + len(changed)))
        touched = store([_touched(part, mark, upto, changed) for part in parts], path)
        number = touched.count()
    parts = [
        _stamped(_batch(part, customers, products, withdraw=mark is not None), now)
        for part in slices(touched, "order_id", passes_for(number, _CORE_SHUFFLES))
    ]
    write_table(parts, f"{target}/load_batch={batch_label(seen.last or mark)}", fmt=fmt, known_non_empty=True)
    store_marks(spark, marks, {PROCESSOR: upto or mark, seen.name: seen.now})
    seen.keep()
    if path is not None:
        discard(spark, path)
    return True


def _batch(touched: DataFrame, customers: DataFrame, products: DataFrame, *, withdraw: bool) -> DataFrame:
    """``silver_core`` of touched orders, and withdrawals of those that it leaves out."""
    rows = silver_core(touched, customers, products).withColumn(WITHDRAWN, F.lit(False))
    if not withdraw:
        return rows
    gone = touched.select("order_id").join(rows.select("order_id"), "order_id", "left_anti")
    return rows.unionByName(gone.withColumn(WITHDRAWN, F.lit(True)), allowMissingColumns=True)


def _touched(
    orders: DataFrame, mark: datetime, upto: datetime | None, changed: Mapping[str, tuple[str, DataFrame]]
) -> DataFrame:
    """Orders loaded after the mark, and those with a changed key."""
    if not changed:
        return since(orders, LOADED_AT, mark, upto)
    condition = (F.col(LOADED_AT) > F.lit(mark)) if upto is not None else F.lit(False)
    rows = orders
    for name, (key, keys) in changed.items():
        rows = rows.join(keys.select(F.col(key).alias(f"_{name}")), F.col(key) == F.col(f"_{name}"), "left")
        condition = condition | F.col(f"_{name}").isNotNull()
    return rows.where(condition).select(*orders.columns)


class SeenRows:
    """The versions of dimension rows that a processor saw in its last run, and those it sees now.

    Each run stores the versions under the time it started. The run's time is
    stored together with the marks; a run that did not get so far leaves versions
    that nothing refers to, and the next run removes them.
    """

    def __init__(
        self, spark: SparkSession, marks: str, processor: str, dimensions: Mapping[str, tuple[str, DataFrame]]
    ):
        self.spark, self.name, self.dimensions = spark, f"{processor}:run", dimensions
        self.last, self.now = read_mark(spark, marks, self.name), datetime.now()
        self.root = f"{marks.rstrip('/')}_versions/{processor}"
        for name, (key, rows) in dimensions.items():
            ignore = {LOADED_AT, SOURCE_FILE, OP_COLUMN, *CHANGE_TIMES}
            row_versions(rows, key, ignore).write.mode("overwrite").parquet(self._path(self.now, name))

    def changed(self) -> dict[str, tuple[str, DataFrame]]:
        """Key column and keys of each dimension that differs from the last run; all keys if that is not known."""
        found = {}
        for name, (key, _) in self.dimensions.items():
            before = None if self.last is None else read_if_exists(self.spark, self._path(self.last, name))
            keys = changed_keys(before, self.spark.read.parquet(self._path(self.now, name)), key)
            # Stored, so that it is found once and that its true size decides how it is joined.
            path = self._path(self.now, f"{name}-changed")
            keys.write.mode("overwrite").parquet(path)
            keys = self.spark.read.schema(keys.schema).parquet(path)
            if not keys.isEmpty():
                found[name] = key, keys
        return found

    def keep(self) -> None:
        """The versions of this run are the last ones; others go."""
        for label in names_in(self.spark, self.root):
            if label != batch_label(self.now):
                discard(self.spark, f"{self.root}/{label}")

    def forget(self) -> None:
        """This run changed nothing."""
        discard(self.spark, f"{self.root}/{batch_label(self.now)}")

    def _path(self, run: datetime, name: str) -> str:
        return f"{self.root}/{batch_label(run)}/{name}"


def merged_sources(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """One row per order, customer and product over both of its sources, and the latest price per product."""
    merged = {
        name: union_latest(
            [_timed(drop_lineage(sources[t])) for t in union.tables if t in sources],
            union.key,
            union.order_by,
            tie_break=union.tie_break,
        )
        for name, union in UNIONS.items()
    }
    merged["api_pricing"] = latest_per_key(
        drop_lineage(sources["api_pricing"]), ["product_id"], "price_date", tie_break=()
    )
    # Every dimension is one row per key; orders, the left side, need not be known to be.
    return {name: df if name == "all_orders" else known_unique(df, _KEYS[name]) for name, df in merged.items()}


_KEYS = {join.right: join.right_key for join in ENRICH_JOINS}


def enrich_left(sources: Mapping[str, DataFrame], *, as_of: str | None = None) -> DataFrame:
    """Orders of all sources with customer, product and latest price, and the
    derived columns.

    The result has one row per order already: the union keeps the latest
    version of each order while ``updated_at`` is still there, and every table
    joined to it is one row per key. Prices have one row per product and day.
    Deduplicating again after the joins would
    shuffle the widest rows for nothing.
    """
    return _enriched(merged_sources(sources), as_of)


def _enriched(merged: Mapping[str, DataFrame], as_of: str | None, spread_by: str | None = None) -> DataFrame:
    """``enrich_left`` of merged sources. ``spread_by`` shuffles the rows on a column for a
    partitioned write, before the derived columns make them wider."""
    joined = join_chain(merged, ENRICH_JOINS)
    if spread_by is not None:
        joined = joined.drop(*DROPPED_COLUMNS).hint("rebalance", spread_by)
    derived = add_customer_age(derive(joined, DERIVED_COLUMNS), as_of)
    return derived.drop(*DROPPED_COLUMNS)


def _by_days(
    merged: Mapping[str, DataFrame], rows: int, path: str, as_of: str | None, days: list[date | None] | None = None
) -> tuple[list[DataFrame], list[list[tuple]], int]:
    """Enriched orders in frames of few enough days each, the days of each, and the number of orders.

    The latest version of each order is found once, in passes for ``rows`` rows of all sources, and stored
    below ``path``, by day within each task, so that a frame reads little beyond its days; for several frames
    the tables joined to them are stored too. With ``days``
    only orders of these ``order_date`` values (NULL too) are enriched.
    """
    parts = slices(merged["all_orders"], "order_id", passes_for(rows))
    if days is not None:
        chosen = parts[0].sparkSession.createDataFrame([(d,) for d in days], "_day date")
        parts = [part.join(chosen, part["order_date"].eqNullSafe(chosen["_day"]), "left_semi") for part in parts]
    orders = store([part.sortWithinPartitions("order_date") for part in parts], f"{path}/orders")
    wanted = None if days is None else [(d,) for d in days]
    groups = value_groups(orders, ["order_date"], wanted, _ENRICHED_SHUFFLES)
    if len(groups) > 1:
        merged = {name: df if name == "all_orders" else store([df], f"{path}/{name}") for name, df in merged.items()}
    frames = [
        _enriched({**merged, "all_orders": part}, as_of, "order_date") for part in of_groups(orders, ["order_date"], groups)
    ]
    return frames, groups, orders.count()


class RepeatedOrderError(ValueError):
    """Rows that must be one per order are not."""


@removing_shuffles
def run_silver_enriched(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    target: str,
    *,
    as_of: str | None = None,
    fmt: str = "parquet",
    load_mode: str = "full",
    marks: str | None = None,
) -> bool:
    """Write ``enrich_left`` by order date; False when there was nothing to write.

    All joins keep every order, so the output is empty only if the order
    sources are, which is cheap to see. That no join repeats an order is seen on the
    write: orders before and rows after the joins are counted, and ``RepeatedOrderError``
    leaves the old table (a full run) or the marks (an incremental one). Many orders are enriched
    and written in passes of some days each (``operators.passes``).

    An incremental run replaces the touched days: those that orders loaded after the
    stored mark have now and had before, and those of orders whose customer, product or
    price came, went or changed since the last run. Orders without a date are a day of
    their own. The days are noted beside the marks for ``refresh_marts``; the marks are stored last.
    """
    orders = [sources[t] for t in UNIONS["all_orders"].tables if t in sources]
    if load_mode == "incremental":
        return _replace_days(spark, sources, orders, target, as_of, fmt, marks)
    rows = sum(df.count() for df in orders)
    if not rows:
        return False
    path, now = scratch_path(spark, "latest-orders"), one_moment()
    try:
        frames, _, number = _by_days(merged_sources(sources), rows, path, as_of)
        frames = [_stamped(df, now) for df in frames]
        written = [Observation() for _ in frames]
        write_table(
            frames if len(frames) > 1 else frames[0],
            target,
            fmt=fmt,
            partition_by=("order_date",),
            spread=False,
            known_non_empty=True,
            observation=written,
            check=lambda: _unrepeated(number, written),
        )
    finally:
        discard(spark, path)
    if marks is not None:
        _note_days(spark, marks, datetime.now(), None)
    return True


def _replace_days(spark, sources, orders, target, as_of, fmt, marks) -> bool:
    mark = read_mark(spark, marks, ENRICHED)
    merged = merged_sources(sources)
    keys = {"all_customers": "customer_id", "all_products": "product_id", "api_pricing": "product_id"}
    seen = SeenRows(spark, marks, ENRICHED, {name: (key, merged[name]) for name, key in keys.items()})
    changed = seen.changed() if mark is not None else {}
    loaded = [_loaded(df, mark) for df in orders]
    found = [load.mark for load in loaded if load.mark is not None]
    if not found and not changed:
        seen.forget()
        return False
    upto = max(found, default=mark)
    fresh = union_sources(
        [since(df, LOADED_AT, mark, upto).select("order_id", "order_date") for df in orders]
    )
    days = fresh.select("order_date")
    before = read_if_exists(spark, target, fmt)
    if before is not None:
        days = days.union(before.join(fresh, "order_id", "left_semi").select("order_date"))
        for key, rows in changed.values():
            days = days.union(before.join(rows, key, "left_semi").select("order_date"))
    # As many rows as days were touched; read before their folders are replaced.
    touched = [r.order_date for r in days.distinct().collect()]
    if touched:
        path, now = scratch_path(spark, "latest-orders"), one_moment()
        try:
            frames, groups, number = _by_days(merged, sum(load.rows for load in loaded), path, as_of, touched)
            written = [Observation() for _ in frames]
            for df, group, counted in zip(frames, groups, written, strict=True):
                df = _stamped(df, now).observe(counted, F.count(F.lit(1)).alias("rows"))
                replace_partitions(df, target, ("order_date",), group, fmt=fmt, spread=False)
            _unrepeated(number, written)
        finally:
            discard(spark, path)
        _note_days(spark, marks, seen.now, None if mark is None else touched)
    store_marks(spark, marks, {ENRICHED: upto, seen.name: seen.now})
    seen.keep()
    return bool(touched)


def _unrepeated(orders: int, written: Sequence[Observation]) -> None:
    rows = sum(metric(seen, "rows", 0) for seen in written)
    if rows > orders:
        raise RepeatedOrderError(f"{rows} rows were made from {orders} orders")


def _note_days(spark: SparkSession, marks: str, run: datetime, days: list | None) -> None:
    """Note which days a run has replaced; None stands for all."""
    rows = [(run, None, True)] if days is None else [(run, d, False) for d in days]
    noted = spark.createDataFrame(rows, "run_at timestamp, order_date date, everything boolean")
    path = f"{marks.rstrip('/')}_days"
    noted.coalesce(1).write.mode("append").parquet(path)
    fold_files(spark, path, DataFrame.distinct)


def noted_days(spark: SparkSession, marks: str, after: datetime | None) -> DataFrame | None:
    """(run_at, order_date, everything) of the runs of enriched silver after a time; None if none was ever noted."""
    noted = read_if_exists(spark, f"{marks.rstrip('/')}_days")
    return None if noted is None else since(noted, "run_at", after)


def silver_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Silver orders; over several batches, the latest version of each that is not withdrawn."""
    rows = read_table(spark, path, fmt)
    if "load_batch" not in rows.columns:
        return rows
    latest = latest_per_key(rows, ["order_id"], SILVER_LOADED_AT, tie_break=[F.desc("load_batch")])
    if WITHDRAWN not in rows.columns:
        return latest
    return latest.where(~F.coalesce(WITHDRAWN, F.lit(False))).drop(WITHDRAWN)


def _loaded(orders: DataFrame, mark: datetime | None) -> Row:
    """The latest load time after a mark, as ``mark``, and the number of all orders, as ``rows``."""
    time = F.col(LOADED_AT) if mark is None else F.when(F.col(LOADED_AT) > F.lit(mark), F.col(LOADED_AT))
    return orders.agg(F.max(time).alias("mark"), F.count(F.lit(1)).alias("rows")).first()


def _stamped(df: DataFrame, now: Column) -> DataFrame:
    return df.withColumn(SILVER_LOADED_AT, now)


def _timed(df: DataFrame) -> DataFrame:
    """Change times as timestamps; tables without them get NULL."""
    if "updated_at" not in df.columns:
        return df.withColumn("updated_at", F.lit(None).cast("timestamp"))
    return df.withColumn("updated_at", F.col("updated_at").try_cast("timestamp"))
