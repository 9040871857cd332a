"""Profiles kept per ingest batch and merged (R1-R28, A6, A7): a grown table is
reported without reading its earlier batches.

``write_states`` profiles one batch into four small tables, a partition each:

* ``profile_scalars``: the counters and extrema of all scalar reports, and sums
  for the averages (one row),
* ``profile_counts``: rows per value or value group, one ``GROUPING SETS`` pass;
  medians, percentiles and the distinct counts of the reports come from them,
* ``profile_sketches``: a HyperLogLog sketch per column, for R4 only,
* ``profile_samples_*``: the first offending rows of each sample report.

``merged_profile`` adds counts, takes extrema, unions sketches, and shapes the
results by the reports' own functions. All reports equal those of the whole
table, except R4, whose distinct counts are estimates: their relative standard
error is 1.04 / sqrt(2 ** LG_K). (``cardinality_profile`` stays exact.)

A batch written again, after a failure, replaces its own states. The states
hold for the rules and dates of the ``cfg`` they were written with.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..sources.tables import Layout, read_table, write_part
from . import profile as R

SCALARS, COUNTS, SKETCHES, SAMPLES = "profile_scalars", "profile_counts", "profile_sketches", "profile_samples"
#: Sketches have 2 ** LG_K registers (16 KB at most): a standard error of 0.8 %.
LG_K = 14
#: Value counts beside those of the grouped reports.
VALUES = {"age_value": ["vict_age"], "type": ["crm_cd"], "place": ["location"]}
GROUPINGS = {**R.GROUPINGS, **VALUES}
#: Column -> the counts that hold its values.
DISTINCT_FROM = {"crm_cd": "type", "area": "area", "rpt_dist_no": "district", "location": "place"}
#: Results that do not add up; they are computed from counts and sums.
DERIVED = ("avg_days", "median_days", "p90_days", "avg_lat", "avg_lon", "avg_length", "avg_age", "median_age", "ks__4", "ks__5")
SAMPLE_REPORTS = {
    "illogical_dates_sample": lambda df, cfg: R.illogical_dates_sample(df),
    "future_dates_sample": R.future_dates_sample,
    "coordinate_bounds_sample": R.coordinate_bounds_sample,
    "age_validity_sample": R.age_validity_sample,
}


def _aggregates(df: DataFrame, cfg: C.Config) -> dict[str, Column]:
    """The aggregates of all scalar reports by name; equal names are equal expressions."""
    every = [a for spec in R.SCALAR_SPECS.values() for a in spec(df, cfg)[0]]
    out: dict[str, Column] = {}
    for name, a in zip(df.agg(*every).columns, every):
        out.setdefault(name, a)
    return out


def _merged(name: str) -> Column:
    """How a stored aggregate of two batches becomes that of both."""
    kind = name.removeprefix("dr__").split("_")[0]
    return {"min": F.min, "max": F.max}.get(kind, F.sum)(f"`{name}`").alias(name)


def _group_keys() -> dict[str, Column]:
    return {**R._group_keys(), **{c: F.col(c) for columns in VALUES.values() for c in columns}}


def write_states(df: DataFrame, layout: Layout, batch: int, cfg: C.Config = C.DEFAULT) -> None:
    """The states of a batch's rows: three scans of them, and one per sample."""
    stored = [a for name, a in _aggregates(df, cfg).items() if name not in DERIVED]
    sums = [F.sum("lat").alias("sum__lat"), F.sum("lon").alias("sum__lon"), F.sum(F.length("location")).alias("sum__length")]
    write_part(df.agg(*stored, *sums), layout.path(SCALARS), batch=batch)

    keys = _group_keys()
    columns = list(keys)
    which = None
    for name, present in GROUPINGS.items():
        is_it = F.grouping_id() == R._grouping_id(columns, present)
        which = F.when(is_it, name) if which is None else which.when(is_it, name)
    counts = (df.select(*[e.alias(c) for c, e in keys.items()])
              .groupingSets([[F.col(c) for c in present] for present in GROUPINGS.values()], *[F.col(c) for c in columns])
              .agg(F.count(F.lit(1)).alias(R.CNT), which.alias("grouping")))
    write_part(counts, layout.path(COUNTS), batch=batch)

    pairs = F.explode(F.array(*[F.struct(F.lit(f.name).alias("column_name"), R._distinct_text(F.col(f"`{f.name}`"), f.dataType).alias("v"))
                                for f in df.schema.fields])).alias("p")
    sketches = (df.select(pairs).select("p.column_name", "p.v").groupBy("column_name")
                .agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("known"), F.hll_sketch_agg("v", F.lit(LG_K)).alias("sketch")))
    write_part(sketches, layout.path(SKETCHES), batch=batch)
    for name, report in SAMPLE_REPORTS.items():
        write_part(report(df, cfg), layout.path(f"{SAMPLES}_{name}"), batch=batch)


def merged_counts(spark: SparkSession, layout: Layout, grouping: str) -> DataFrame:
    """Rows per value (group) over all batches."""
    return (read_table(spark, layout.path(COUNTS)).filter(F.col("grouping") == grouping)
            .groupBy(*GROUPINGS[grouping]).agg(F.sum(R.CNT).alias(R.CNT)))


def sketched_distinct(spark: SparkSession, layout: Layout) -> DataFrame:
    """Per column: distinct values (NULL is one) by the united sketches, and rows."""
    one = read_table(spark, layout.path(SKETCHES)).groupBy("column_name").agg(
        F.sum("rows").alias("__n"), F.sum("known").alias("known"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("d"))
    return one.select("column_name", (F.col("d") + F.when(F.col("known") < F.col("__n"), 1).otherwise(0)).alias("distinct_count"), "__n")


def _value_stats(counts: DataFrame, column: str, percentages: Sequence[float]) -> Column:
    """Average and exact percentiles of a column from its value counts, as a subquery."""
    n, v = F.col(R.CNT), F.col(column)
    return counts.agg(F.struct(
        F.try_divide(F.sum(v * n).cast("double"), F.sum(F.when(v.isNotNull(), n))).alias("avg"),
        *[F.percentile(v, p, n).alias(f"p{i}") for i, p in enumerate(percentages)])).scalar()


def merged_profile(spark: SparkSession, layout: Layout, schema: T.StructType, cfg: C.Config = C.DEFAULT) -> dict[str, DataFrame]:
    """Report name -> report, over all batches. ``schema``: that of the profiled rows."""
    like = spark.createDataFrame([], schema)
    names = [n for n in _aggregates(like, cfg) if n not in DERIVED]
    one = read_table(spark, layout.path(SCALARS)).agg(*[_merged(n) for n in [*names, "sum__lat", "sum__lon", "sum__length"]])
    lag = _value_stats(merged_counts(spark, layout, "lag"), "days_to_report", (0.5, 0.9))
    age = _value_stats(merged_counts(spark, layout, "age_value"), "vict_age", (0.5,))
    one = one.withColumns({"_lag": lag, "_age": age}).withColumns({
        "avg_days": F.round("_lag.avg", 4), "median_days": F.col("_lag.p0"), "p90_days": F.col("_lag.p1"),
        "avg_age": F.round("_age.avg", 4), "median_age": F.col("_age.p0"),
        "avg_lat": F.round(F.try_divide("sum__lat", "non_null_lat"), 6), "avg_lon": F.round(F.try_divide("sum__lon", "non_null_lon"), 6),
        "avg_length": F.round(F.try_divide(F.col("sum__length").cast("double"), F.col("non_null_locations")), 4),
        "ks__4": F.datediff("dr__max_date_occ", "dr__min_date_occ"), "ks__5": F.round("_lag.avg", 2)})
    specs = {name: spec(like, cfg) for name, spec in R.SCALAR_SPECS.items()}
    distinct = {alias: column for _, distincts, _ in specs.values() for alias, column in distincts.items()}
    one = one.withColumns({alias: merged_counts(spark, layout, DISTINCT_FROM[c]).agg(F.count_distinct(c)).scalar()
                           for alias, c in distinct.items()})
    out = {name: shape(one) for name, (_, _, shape) in specs.items()}
    for report, (grouping, shape) in R.GROUPED_REPORTS.items():
        out[report] = shape(merged_counts(spark, layout, grouping))
    out["cardinality_profile"] = R._cardinality_report(sketched_distinct(spark, layout))
    for name, report in SAMPLE_REPORTS.items():
        out[name] = report(read_table(spark, layout.path(f"{SAMPLES}_{name}")), cfg)
    return out
