"""Row generators (S7, S8) and small code tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine(spark: SparkSession, start: str, end: str, name: str = "full_date") -> DataFrame:
    """One row per calendar day from ``start`` to ``end`` inclusive.

    Built with ``spark.range`` over the day offsets, so the generator is
    partitioned like any other scan instead of exploding one array row.
    """
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days
    return spark.range(0, days + 1).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(name))


def minute_spine(spark: SparkSession, name: str = "minutes_since_midnight") -> DataFrame:
    """0..1439, one row per minute of the day."""
    return spark.range(0, 1440).select(F.col("id").cast("int").alias(name))


def code_table(spark: SparkSession, mapping: Mapping[str, str], key: str = "code",
               value: str = "label") -> DataFrame:
    """A small (tens of rows) lookup table from a Python mapping."""
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")
