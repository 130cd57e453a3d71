"""Declarations passed to the operators: tables, joins, unions, marts, gates.

Each one is a frozen value object; a bad declaration raises ``ValueError`` at
construction, before Spark plans anything.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
RAW_OP_COLUMN = "_op"
OP_COLUMN = "dms_operation"
LOADED_AT = "bronze_loaded_at"
SOURCE_FILE = "bronze_source_file"
SILVER_LOADED_AT = "silver_loaded_at"
LINEAGE_COLUMNS = (LOADED_AT, SOURCE_FILE, OP_COLUMN)

SOURCE_FORMATS = ("csv", "json", "parquet")

_SIMPLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}
_DECIMAL = re.compile(r"decimal(?:type)?\(\s*(?P<precision>\d*)\s*(?:,\s*(?P<scale>\d+)\s*)?\)")


def column_type(declared: str | None) -> T.DataType:
    """Spark type of a declared type name such as ``integer``, ``DateType`` or
    ``decimal(12,3)``.

    Names ignore case. A decimal without a readable precision and scale is
    decimal(10,2), and any unknown name is a string.
    """
    name = (declared or "string").strip().lower()
    if name.startswith("decimal"):
        match = _DECIMAL.fullmatch(name)
        if match is None:
            return T.DecimalType(10, 2)
        return T.DecimalType(int(match["precision"] or 10), int(match["scale"] or 2))
    return _SIMPLE_TYPES.get(name.removesuffix("type"), T.StringType())


def struct_from_columns(columns: Sequence[Mapping]) -> T.StructType:
    """``StructType`` of a list of ``{"name", "type", "nullable"}`` entries."""
    if not columns:
        raise ValueError("a schema needs at least one column")
    return T.StructType(
        [
            T.StructField(c["name"], column_type(c.get("type")), c.get("nullable", True))
            for c in columns
        ]
    )


def write_mode(load_mode: str) -> str:
    """Save mode of a load mode; anything but ``incremental`` replaces the table."""
    return "append" if load_mode == "incremental" else "overwrite"


@dataclass(frozen=True)
class Gate:
    """Limits a table must meet; percentages are 0..100 and compared strictly."""

    null_percent: Mapping[str, float] = field(default_factory=dict)
    min_rows: int | None = None
    max_quarantine_percent: float = 20.0
    fail_on_zero_rows: bool = True


@dataclass(frozen=True)
class TableSpec:
    """One raw table: where its columns come from and how it is loaded."""

    name: str
    source_format: str
    primary_key: str
    schema: T.StructType
    load_mode: str = "full"
    read_options: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    #: Column whose greatest value is kept when a key repeats within a load.
    newest_by: str = "updated_at"
    #: Column names of a change feed, without the leading operation letter.
    change_columns: tuple[str, ...] = ()
    #: Column -> JSON path, for declared flat columns that arrive nested.
    json_paths: Mapping[str, str] = field(default_factory=dict)
    gate: Gate = Gate()

    def __post_init__(self) -> None:
        if self.source_format not in SOURCE_FORMATS:
            raise ValueError(f"{self.name}: unsupported format {self.source_format!r}")
        if self.primary_key not in self.schema.names:
            raise ValueError(f"{self.name}: key {self.primary_key!r} is not in the schema")
        if self.change_columns and self.source_format != "csv":
            raise ValueError(f"{self.name}: change feeds are read from CSV")

    @property
    def is_change_feed(self) -> bool:
        return bool(self.change_columns)


@dataclass(frozen=True)
class JoinSpec:
    """``left`` join ``right``; ``left=None`` stands for the running result."""

    right: str
    left_key: str
    right_key: str
    how: str = "left"
    left: str | None = None
    #: New names for columns of the right side.
    rename: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.how not in ("inner", "left"):
            raise ValueError(f"join type {self.how!r} is not supported")


@dataclass(frozen=True)
class UnionSpec:
    """Same-entity tables merged into one row per key, latest first.

    ``tie_break`` decides between rows of one key, time and table. It names as few
    columns as do, because each one is read and shuffled whatever a query needs.
    """

    tables: tuple[str, ...]
    key: str
    order_by: str
    tie_break: tuple[str, ...] = ()


@dataclass(frozen=True)
class MartSpec:
    """Grain columns and ``{metric name: SQL aggregate}``.

    A mart that counts rows as distinct keys names the key in ``unique_by``: whoever
    builds it must know that no row repeats one (see ``plans.gold.run_marts``).
    """

    grain: tuple[str, ...]
    metrics: Mapping[str, str]
    partition_by: tuple[str, ...] = ()
    unique_by: str | None = None

    def __post_init__(self) -> None:
        if not self.grain or not self.metrics:
            raise ValueError("a mart needs a grain and at least one metric")


@dataclass(frozen=True)
class DimensionSpec:
    """One row per key; attributes map output name -> source column."""

    key: str
    attributes: Mapping[str, str]
    order_by: str | None = None
