"""Layers composed from the operators."""

from ledgerloom.plans.bronze import bronze_table, run_bronze
from ledgerloom.plans.gold import gold_tables, mart_tables, refresh_marts, run_gold, run_marts
from ledgerloom.plans.medallion import run_medallion
from ledgerloom.plans.silver import (
    RepeatedOrderError,
    enrich_left,
    run_silver,
    run_silver_enriched,
    silver_core,
    silver_table,
)

__all__ = [
    "RepeatedOrderError",
    "bronze_table",
    "enrich_left",
    "gold_tables",
    "mart_tables",
    "refresh_marts",
    "run_bronze",
    "run_gold",
    "run_marts",
    "run_medallion",
    "run_silver",
    "run_silver_enriched",
    "silver_core",
    "silver_table",
]
