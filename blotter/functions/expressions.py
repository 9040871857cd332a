"""Column-level building blocks (P6-P11, E-series helpers).

Every function returns a ``Column`` made of Spark built-ins only, so it stays
inside whole-stage codegen and works the same on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def bucketize(col: Column | str, bands: Sequence[tuple[float, str]], default: str,
              first: Sequence[tuple[Column, str]] = ()) -> Column:
    """Ordered CASE: ``first`` conditions, then ``col < upper`` per band, else default."""
    c = _c(col)
    expr = None
    for cond, label in list(first) + [(c < upper, label) for upper, label in bands]:
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def code_label(col: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """Map codes to labels with an ordered CASE; unknown and NULL get ``default``."""
    c = _c(col)
    expr = None
    for code, label in mapping.items():
        expr = F.when(c == code, label) if expr is None else expr.when(c == code, label)
    return expr.otherwise(default)


def regex_category(col: Column | str, patterns: Sequence[tuple[str, str]], default: str) -> Column:
    """Ordered case-insensitive regex categories; first match wins."""
    c = _c(col)
    expr = None
    for pattern, label in patterns:
        cond = c.rlike(f"(?i){pattern}")
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def out_of_range(col: Column | str, lo: float, hi: float) -> Column:
    """``col < lo OR col > hi`` (NULL stays NULL, i.e. not counted)."""
    c = _c(col)
    return (c < lo) | (c > hi)


def region_of(area: Column | str) -> Column:
    a = _c(area)
    expr = None
    for name, areas in C.REGIONS:
        expr = F.when(a.isin(areas), name) if expr is None else expr.when(a.isin(areas), name)
    return expr.otherwise(C.REGION_OTHER)


def hour_band(hour: Column | str, bands: Sequence[tuple[int, int, str]], default: str) -> Column:
    h = _c(hour)
    expr = None
    for lo, hi, label in bands:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def time_period(hour: Column | str) -> Column:
    """Night / Morning / Afternoon; everything else, NULL included, is Evening."""
    return hour_band(hour, C.TIME_PERIODS, C.TIME_PERIOD_OTHER)


def hhmm_text(time_occ: Column | str) -> Column:
    """HHMM text: left-pad to 4 with zeros (longer inputs are truncated to 4)."""
    return F.lpad(_c(time_occ).cast("string"), 4, "0")


def hhmm_hour(time_str: Column | str) -> Column:
    """Hour = characters 1-2 of the HHMM text; unparsable text gives NULL."""
    return F.substring(_c(time_str), 1, 2).try_cast("int")


def hhmm_minute(time_str: Column | str) -> Column:
    """Minute = characters 3-4 of the HHMM text; unparsable text gives NULL."""
    return F.substring(_c(time_str), 3, 2).try_cast("int")


def raw_age_band(age: Column | str) -> Column:
    """Profiling bands on the raw age: 0 Unknown, negatives fall in 0-17, NULL/>=120 Invalid."""
    a = _c(age)
    return bucketize(a, C.RAW_AGE_BANDS, C.RAW_AGE_INVALID, first=[(a == 0, C.AGE_UNKNOWN)])


def rule(expr_text: str) -> Column:
    """A named quality rule as a boolean where NULL counts as failing."""
    return F.coalesce(F.expr(expr_text), F.lit(False))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    """Percentage rounded as DOUBLE (NULL when the denominator is 0)."""
    return F.round(num.cast("double") * 100.0 / F.when(den != 0, den.cast("double")), digits)
