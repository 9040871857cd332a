"""Data quality operators (Q1-Q7).

Rules are SQL boolean texts; a rule that evaluates to NULL counts as failed.
All counters are computed in one aggregate pass (partial aggregation on the
map side, one tiny final merge), never as one job per rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation  # noqa: F401 (annotation)
from pyspark.sql import functions as F

from ..functions import expressions as X


def _passes_all(rules: Mapping[str, str]) -> Column:
    cond = F.lit(True)
    for text in rules.values():
        cond = cond & X.rule(text)
    return cond


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str],
                       observe_name: "str | Observation | None" = None) -> DataFrame:
    """Q1: keep rows passing every rule.

    With ``observe_name`` the input row count and per-rule failure counts are
    attached as observed metrics before the filter, computed by the same pass
    that writes the rows: a name for streams (metrics in the query
    progress), or a ``pyspark.sql.Observation`` for batch (``.get`` after the
    action).
    """
    if observe_name is not None:
        metrics = [F.count(F.lit(1)).alias("rows_in")]
        metrics += [F.count_if(~X.rule(t)).alias(f"failed_{n}") for n, t in rules.items()]
        metrics.append(F.count_if(~_passes_all(rules)).alias("rows_dropped"))
        df = df.observe(observe_name, *metrics)
    return df.filter(_passes_all(rules))


def expectation_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Q2: one row per rule: rows checked, passed, failed, % failed."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    aggs += [F.count_if(~X.rule(t)).alias(n) for n, t in rules.items()]
    one = df.agg(*aggs)
    long = one.unpivot("__n", list(rules), "rule", "failed")
    return long.select(
        "rule",
        F.col("__n").alias("rows_checked"),
        (F.col("__n") - F.col("failed")).alias("passed"),
        "failed",
        X.pct(F.col("failed"), F.col("__n")).alias("pct_failed"),
    )


def failed_rules_expr(rules: Mapping[str, str]) -> Column:
    """Comma-separated names of the rules a row fails ('' when none)."""
    return F.concat_ws(",", *[F.when(~X.rule(t), F.lit(n)) for n, t in rules.items()])


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Q3: rows failing at least one rule, with the names of the rules failed."""
    return df.filter(~_passes_all(rules)).withColumn("failed_rules", failed_rules_expr(rules))


def unexpected_values(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """Q4: distinct non-null values of ``col`` outside ``allowed``, with row
    counts (one grouping, pre-aggregated per task)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("rows")))


def orphan_keys(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Q5: per foreign key of ``child`` (``parents``: foreign key -> (table, its
    key)): rows with a NULL key, rows whose non-null key has no parent, and
    how many such keys.

    One scan of the child: its keys are stacked to (foreign_key, key) and
    counted (partial aggregation collapses a hot key in each task), then
    joined once with the stacked keys of the parents.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(fk).alias("foreign_key"), F.col(fk).cast("bigint").alias("k"))
                                  for fk in parents]))
    counts = (child.select(stacked.alias("s")).groupBy("s.foreign_key", "s.k")
              .agg(F.count(F.lit(1)).alias("rows")).alias("c"))
    known = None
    for fk, (table, key) in parents.items():
        one = table.select(F.lit(fk).alias("foreign_key"), F.col(key).cast("bigint").alias("k"))
        known = one if known is None else known.unionByName(one)
    known = known.distinct().withColumn("found", F.lit(True)).alias("p")
    j = counts.join(known, (F.col("c.foreign_key") == F.col("p.foreign_key")) & (F.col("c.k") == F.col("p.k")), "left")
    null, orphan = F.col("c.k").isNull(), F.col("c.k").isNotNull() & F.col("found").isNull()
    return j.groupBy("c.foreign_key").agg(
        F.sum(F.when(null, F.col("rows")).otherwise(0)).cast("bigint").alias("null_rows"),
        F.sum(F.when(orphan, F.col("rows")).otherwise(0)).cast("bigint").alias("orphan_rows"),
        F.count_if(orphan).alias("orphan_keys"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q6: key values held by more than one row, with their row counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def key_collisions(dim: DataFrame, key: str, natural: Sequence[str]) -> DataFrame:
    """Q7: surrogate keys shared by more than one natural key.

    Natural keys are made unique per surrogate key first, so NULL parts are
    kept as values (a NULL part is a member of its own).
    """
    members = dim.select(key, *natural).distinct()
    return (members.groupBy(key).agg(F.count(F.lit(1)).alias("natural_keys"))
            .filter(F.col("natural_keys") > 1))


def key_collision_summary(dim: DataFrame, key: str, natural: Sequence[str], name: str) -> DataFrame:
    """Q7 as one summary row: members, distinct keys and colliding keys."""
    per_key = dim.select(key, *natural).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("m"))
    return per_key.agg(
        F.lit(name).alias("dimension"),
        F.coalesce(F.sum("m"), F.lit(0)).cast("bigint").alias("members"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("m") > 1).alias("colliding_keys"),
    )
