"""Aggregate building blocks (A1-A13), ordering/limits (T1-T5) and period
change (W1, W2).

All of them are plain grouped aggregates: Spark computes a partial aggregate
in every task and merges per key after the shuffle, so a key holding a large
share of the rows is collapsed before it is moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_rules(df: DataFrame, predicates: Mapping[str, Column], total: str | None = "total_rows") -> DataFrame:
    """A2: one row with a count of rows per predicate (NULL predicate = not
    counted), all in one pass."""
    aggs = [F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()]
    if total:
        aggs.insert(0, F.count(F.lit(1)).alias(total))
    return df.agg(*aggs)


def distinct_with_null(col: str, approx: bool = False) -> Column:
    """Distinct values of ``col`` counting NULL as one more value."""
    c = F.col(col)
    d = F.approx_count_distinct(c) if approx else F.count_distinct(c)
    return d + F.max(F.when(c.isNull(), 1).otherwise(0))


def numeric_stats(df: DataFrame, cols: Sequence[str], median: bool = False) -> DataFrame:
    """A4/A5: min, max, avg (and exact median) per column, one row."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"), F.avg(c).alias(f"avg_{c}")]
        if median:
            aggs.append(F.percentile(c, 0.5).alias(f"median_{c}"))
    return df.agg(*aggs)


def percentile_expr(col: Column | str, p: float, approx: bool = False, accuracy: int = 10_000) -> Column:
    """A5: exact interpolated percentile (as DOUBLE), or opt-in approximate.

    The exact aggregate keeps a value -> count map per task and merges maps,
    so its memory grows with the distinct values, not the rows."""
    c = F.col(col) if isinstance(col, str) else col
    if approx:
        return F.percentile_approx(c, p, accuracy).cast("double")
    return F.percentile(c, p)


def date_span(col: Column | str) -> Column:
    """Days between the earliest and the latest value (aggregate)."""
    return F.datediff(F.max(col), F.min(col))


def value_counts(df: DataFrame, keys: Sequence[str | Column], name: str = "count") -> DataFrame:
    """Row count per key combination (NULL is a group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, keys: Sequence[str], k: int, measure: str = "count") -> DataFrame:
    """The ``k`` largest groups by ``measure``; ties broken by the keys
    (ascending, NULLs last) so the result is deterministic. Spark plans
    this as TakeOrderedAndProject: each task keeps its own top k."""
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc_nulls_last() for c in keys]).limit(k)


def first_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """The first ``k`` rows by ``key`` ascending (NULLs first)."""
    return df.orderBy(F.col(key).asc_nulls_first()).limit(k)


def sample_violations(df: DataFrame, predicate: Column, cols: Sequence[str], k: int = 10,
                      order: Sequence[str] | None = None) -> DataFrame:
    """T4: up to ``k`` offending rows, ordered by ``order`` (default: the
    selected columns, NULLs last) so the sample is deterministic."""
    order = list(order or cols)
    return (df.filter(predicate).select(*cols)
            .orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(k))


def preview(df: DataFrame, k: int = 10) -> DataFrame:
    """T5: any ``k`` rows."""
    return df.limit(k)


def period_change(df: DataFrame, period_index: Column, measure: str, prefix: str = "prev") -> DataFrame:
    """Compare each period with the period just before it.

    ``period_index`` numbers periods consecutively (e.g. ``year`` or
    ``year * 4 + quarter``); a missing previous period gives NULL. Every
    aggregated row is emitted twice - as the current value at its index and
    as the previous value at index + 1 - and one grouping by index pairs
    them: a single pass over the (small) aggregated rows, with no self-join
    (which would compute the aggregate twice) and no unpartitioned window.
    """
    keys = [c for c in df.columns if c != measure]
    m = F.col(measure).cast("bigint")
    none = F.lit(None).cast("bigint")
    tagged = df.select(F.explode(F.array(
        F.struct(period_index.alias("i"), F.struct(*keys).alias("k"), m.alias("cur"), none.alias("prev")),
        F.struct((period_index + 1).alias("i"), F.lit(None).alias("k"), none.alias("cur"), m.alias("prev")),
    )).alias("t")).select("t.*").filter(F.col("cur").isNotNull() | F.col("i").isNotNull())
    paired = (tagged.groupBy("i")
              .agg(F.max("k").alias("k"), F.max("cur").alias("cur"), F.max("prev").alias("prev"))
              .filter(F.col("cur").isNotNull()))
    p = F.col(f"{prefix}_{measure}")
    return paired.select(
        *[F.col(f"k.{c}").alias(c) for c in keys],
        F.col("cur").alias(measure), F.col("prev").alias(f"{prefix}_{measure}"),
    ).withColumns({
        "change": F.col(measure) - p,
        "pct_change": F.round((F.col(measure) - p).cast("double") * 100.0 / F.when(p != 0, p.cast("double")), 2),
    })


def union_counts(frames: Mapping[str, DataFrame], label: str = "layer", name: str = "rows") -> DataFrame:
    """UNION ALL of one row count per frame."""
    out = None
    for k, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias(name)).select(F.lit(k).alias(label), name)
        out = one if out is None else out.unionByName(one)
    return out
