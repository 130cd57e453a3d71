"""The session settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key's join even if that costs a shuffle before what follows on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configured(builder: SparkSession.Builder, checkpoint_dir: str) -> SparkSession.Builder:
    """``builder`` with the settings and the shared folder for intermediate tables."""
    for key, value in {**SETTINGS, "spark.checkpoint.dir": checkpoint_dir}.items():
        builder = builder.config(key, value)
    return builder
