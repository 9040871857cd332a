"""Load audit columns (G4): producer name and processing time per layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def load_audit(flow: str, ts: Column | None = None, time_column: str = "created_date") -> dict[str, Column]:
    """``created_by`` = the producing flow, ``time_column`` = processing time
    (``ts`` overrides ``current_timestamp()``, e.g. to make tests stable)."""
    return {"created_by": F.lit(flow), time_column: ts if ts is not None else F.current_timestamp()}


def with_load_audit(df: DataFrame, flow: str, ts: Column | None = None,
                    time_column: str = "created_date") -> DataFrame:
    """Add (or replace) the load audit columns of a layer."""
    return df.withColumns(load_audit(flow, ts, time_column))
