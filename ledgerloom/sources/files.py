"""Scans of the raw formats under a declared schema.

Text formats are read with every field as text plus the parser's corrupt
column, and typed afterwards per column. The reader is told not to prune
columns, so a row of the wrong width is found whatever the query selects; a
field that does not parse is found by its own expression. Both therefore
survive column pruning, and one bad field never blanks its neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import cast_text, parse_text
from ledgerloom.sources.scratch import recover, set_aside
from ledgerloom.specs import CORRUPT_COLUMN, RAW_OP_COLUMN, SOURCE_FILE, TableSpec

#: Reason columns are joined into one text under this name.
CORRUPT_FIELDS = "_corrupt_fields"


def scan(spark: SparkSession, spec: TableSpec, path: str | list[str]) -> DataFrame:
    """Raw table as declared by ``spec``.

    CSV and JSON come back typed, with ``_corrupt_record`` holding the raw
    text of a row that is malformed or has a field that is not of its declared
    type, and ``_corrupt_fields`` naming those fields. Parquet comes back with
    the types of its files. All carry the path of the file they came from.
    ``path`` is a folder or a list of files.
    """
    if spec.is_change_feed:
        return scan_changes(spark, spec, path)
    if spec.source_format == "parquet":
        paths = [path] if isinstance(path, str) else path
        raw = spark.read.options(**spec.read_options).parquet(*paths)
        return raw.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return _typed(_read(spark.read, spec, spec.schema.names, path), spec, parse_text)


def scan_stream(
    spark: SparkSession, spec: TableSpec, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same scan as a file stream: every file is taken once per checkpoint."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if spec.source_format == "parquet":
        raw = reader.options(**spec.read_options).schema(spec.schema).parquet(path)
        return raw.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    if spec.is_change_feed:
        return _read_changes(reader, spec, path)
    return _typed(_read(reader, spec, spec.schema.names, path), spec, parse_text)


def scan_changes(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """Change feed: headerless CSV whose first field is the operation letter.

    Columns outside the schema (creation and change times) stay text, and the
    quarantine rule is the one of every other text source.
    """
    return _read_changes(spark.read, spec, path)


def _read_changes(reader, spec: TableSpec, path: str) -> DataFrame:
    names = (RAW_OP_COLUMN, *spec.change_columns)
    return _typed(_read(reader, spec, names, path), spec, cast_text)


def _read(reader, spec: TableSpec, names, path: str) -> DataFrame:
    reader = (
        reader.options(**spec.read_options)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    )
    if spec.source_format == "json":
        raw, texts = _read_json(reader, spec, names, path)
    else:
        raw = reader.option("columnPruning", "false").schema(_schema(names, "string")).csv(path)
        texts = [F.col(n) for n in names]
    return raw.select(*texts, CORRUPT_COLUMN, F.col("_metadata.file_path").alias(SOURCE_FILE))


def _read_json(reader, spec: TableSpec, names, path: str) -> tuple[DataFrame, list[Column]]:
    """Fields are read as variants, so that any value is accepted, and then
    taken as text. (Reading numbers directly as text would make the parser seek
    back in the file for each of them.)"""
    places = {
        n: _split_json_path(spec.json_paths[n]) if n in spec.json_paths else (n, "$") for n in names
    }
    roots = dict.fromkeys(root for root, _ in places.values())
    raw = reader.schema(_schema(roots, "variant")).json(path)
    texts = [
        F.try_variant_get(F.col(root), rest, "string").alias(n)
        for n, (root, rest) in places.items()
    ]
    return raw, texts


def _schema(names, field_type: str) -> str:
    return ", ".join([*(f"`{n}` {field_type}" for n in names), f"{CORRUPT_COLUMN} string"])


def _split_json_path(path: str) -> tuple[str, str]:
    """``$.address.city`` -> (``address``, ``$.city``)."""
    root = re.match(r"\$\.([^.\[]+)", path)
    if root is None:
        raise ValueError(f"not a JSON path below a column: {path!r}")
    return root[1], "$" + path[root.end():]


def _typed(raw: DataFrame, spec: TableSpec, convert: Callable[[Column, T.DataType], Column]) -> DataFrame:
    declared = {f.name: f.dataType for f in spec.schema.fields}
    text_names = [n for n in raw.columns if n not in (CORRUPT_COLUMN, SOURCE_FILE)]
    values = {n: convert(F.col(n), declared.get(n, T.StringType())) for n in text_names}
    failed = F.array_compact(
        F.array(
            *[
                F.when(F.col(n).isNotNull() & values[n].isNull(), F.lit(n))
                for n in text_names
                if not isinstance(declared.get(n, T.StringType()), T.StringType)
            ]
        )
    )
    bad_fields = F.when(F.size(failed) > 0, F.array_join(failed, ","))
    text_row = F.struct(*text_names)
    separator = spec.read_options.get("delimiter", spec.read_options.get("sep", ","))
    rebuilt = (
        F.to_json(text_row)
        if spec.source_format == "json"
        else F.to_csv(text_row, {"sep": separator})
    )
    return raw.select(
        *[values[n].alias(n) for n in text_names],
        F.coalesce(CORRUPT_COLUMN, F.when(bad_fields.isNotNull(), rebuilt)).alias(CORRUPT_COLUMN),
        bad_fields.alias(CORRUPT_FIELDS),
        SOURCE_FILE,
    )


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame | None:
    """The data at ``path``, or None when nothing has been written there yet.

    A table whose replacement was broken off is first brought back.
    """
    try:
        return spark.read.format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    if not set_aside(spark, path):
        return None
    recover(spark, path)
    return spark.read.format(fmt).options(**options).load(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """The data at ``path``, which must be there."""
    found = read_if_exists(spark, path, fmt, **options)
    return spark.read.format(fmt).options(**options).load(path) if found is None else found
