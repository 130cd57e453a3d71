"""Attributes of a calendar day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_attributes(day: Column) -> list[Column]:
    """The eight columns of a date dimension; weeks start on Sunday = 1."""
    weekday = F.dayofweek(day)
    return [
        day.alias("date"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.coalesce(weekday.isin(1, 7), F.lit(False)).alias("is_weekend"),
    ]


def age_in_years(born: Column, as_of: Column) -> Column:
    """Whole 365-day years between two dates."""
    return F.floor(F.datediff(as_of, born) / 365)
