"""Profiling reports over a raw incident table.

Each scalar report is a pair (aggregates, shape): the aggregates are
``count_if`` / ``min`` / ``max`` / ``percentile`` / ``count_distinct``
columns, and the shape turns the one-row result into report rows with
``unpivot`` or ``inline``. Calling a report function runs its own aggregate;
``profile_all`` merges the aggregates of every scalar report into a single
pass, computes every grouped distribution with one ``GROUPING SETS``
aggregate and the distinct profile with one stacked pass, so profiling a
table costs three scans instead of one per check. Percentages of grouped
reports divide by a scalar subquery over the aggregated rows (no join, no
global window). Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import expressions as X
from .aggregates import (date_span, distinct_with_null, first_k, percentile_expr, sample_violations, top_k,
                         value_counts)

CNT = "count"

# FIXED VALUES: issue catalogue of the quality summary
# (counter, category, issue, severity, recommended action).
ISSUES: list[tuple[str, str, str, str, str]] = [
    ("report_before_occurrence", "Temporal", "Report date before occurrence date", "Medium",
     "Drop in Silver layer (valid_date_logic)"),
    ("out_of_bounds", "Geographic", "Out-of-bounds coordinates", "Low", "Filter or flag for Silver layer"),
    ("zero_coords", "Geographic", "Zero coordinates (0,0)", "Low", "Set to NULL in Silver layer"),
    ("negative_ages", "Demographic", "Negative ages", "Low", "Set to NULL or 0 in Silver"),
    ("zero_ages", "Demographic", "Zero ages (Unknown)", "Medium", 'Create "Unknown" age group'),
    ("missing_sex_descent", "Demographic", "Missing sex/descent", "Medium", 'Handle as "Unknown" in dimensions'),
    ("secondary_codes", "Completeness", "Secondary crime codes (crm_cd_2/3/4)", "Low",
     "Expected - most crimes have 1 code"),
    ("missing_weapons", "Completeness", "Missing weapons", "Low", "Expected - not all crimes involve weapons"),
]

# FIXED VALUES: headline metric names of the key statistics report.
KEY_METRICS = [
    "Unique Crime Types (crm_cd)",
    "LAPD Areas",
    "Reporting Districts",
    "Unique Locations",
    "Date Range (days)",
    "Avg Reporting Lag (days)",
    "Crimes with Weapons",
    "Crimes without Weapons",
    "Juvenile Victims (<18)",
    "Senior Victims (65+)",
]

# (aggregates, {alias: column whose distinct non-null values are counted}, shape)
Spec = tuple[list[Column], dict[str, str], Callable[[DataFrame], DataFrame]]


def _n() -> Column:
    return F.count(F.lit(1))


def _rows(one: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into report rows: each mapping is one row."""
    return one.select(F.inline(F.array(*[F.struct(*[c.alias(k) for k, c in r.items()]) for r in rows])))


def _run(df: DataFrame, spec: Spec) -> DataFrame:
    aggs, distincts, shape = spec
    return shape(df.agg(*aggs, *[F.count_distinct(_q(c)).alias(n) for n, c in distincts.items()]))


def _with_share(counts: DataFrame, name: str = "pct") -> DataFrame:
    """Add the % share of each group, dividing by a scalar subquery total."""
    total = counts.agg(F.sum(CNT)).scalar()
    return counts.withColumn(name, F.round(F.col(CNT).cast("double") * 100.0 / total, 2))


def _lag() -> Column:
    return F.datediff(F.col("date_rptd"), F.col("date_occ"))


def _hour() -> Column:
    return X.hhmm_hour(X.hhmm_text("time_occ"))


def _minute() -> Column:
    return X.hhmm_minute(X.hhmm_text("time_occ"))


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _pct_of(num: str, den: str) -> Column:
    return X.pct(F.col(num), F.col(den))


# ================================================================ scalar specs
def _spec_schema(df: DataFrame, cfg: C.Config) -> Spec:
    fields = df.schema.fields
    aggs = [F.count(_q(f.name)).alias(f"nn__{f.name}") for f in fields]

    def shape(one):
        return _rows(one, [{
            "ordinal": F.lit(i + 1),
            "column_name": F.lit(f.name),
            "data_type": F.lit(f.dataType.simpleString()),
            "nullable": F.lit(f.nullable),
            "non_null_count": _q(f"nn__{f.name}"),
        } for i, f in enumerate(fields)])
    return aggs, {}, shape


def _spec_nulls(df: DataFrame, cfg: C.Config) -> Spec:
    cols = df.columns
    aggs = [_n().alias("total_rows")] + [F.count_if(_q(c).isNull()).alias(f"null__{c}") for c in cols]

    def shape(one):
        wide = one.select(F.col("total_rows").alias("__n"), *[_q(f"null__{c}").alias(c) for c in cols])
        long = wide.unpivot("__n", [_q(c) for c in cols], "column_name", "null_count")
        raw = F.col("null_count").cast("double") * 100.0 / F.col("__n")
        return long.select(
            "column_name", "null_count", F.round(raw, 2).alias("null_pct"),
            (F.col("__n") - F.col("null_count")).alias("non_null_count"),
            F.round(100.0 - raw, 2).alias("completeness_pct"))
    return aggs, {}, shape


def _grade(pct: Column) -> Column:
    expr = None
    for lo, label in C.COMPLETENESS_GRADES:
        expr = F.when(pct >= lo, label) if expr is None else expr.when(pct >= lo, label)
    return expr.otherwise(C.COMPLETENESS_GRADE_LAST)


def _spec_completeness(df: DataFrame, cfg: C.Config) -> Spec:
    cols = df.columns
    aggs = [_n().alias("total_rows")] + [F.count_if(_q(c).isNull()).alias(f"null__{c}") for c in cols]

    def shape(one):
        nulls = None
        for c in cols:
            nulls = _q(f"null__{c}") if nulls is None else nulls + _q(f"null__{c}")
        cells = F.col("total_rows") * len(cols)
        raw = (cells - nulls).cast("double") * 100.0 / cells
        return one.select(
            "total_rows", F.lit(len(cols)).alias("total_columns"), cells.alias("total_cells"),
            nulls.alias("null_cells"), (cells - nulls).alias("non_null_cells"),
            F.round(raw, 2).alias("completeness_pct"), _grade(raw).alias("grade"))
    return aggs, {}, shape


def _spec_date_range(df: DataFrame, cfg: C.Config, cols: Sequence[str] = ("date_occ", "date_rptd")) -> Spec:
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"dr__min_{c}"), F.max(c).alias(f"dr__max_{c}"), F.count(c).alias(f"dr__n_{c}")]

    def shape(one):
        return _rows(one, [{"column_name": F.lit(c), "min_date": F.col(f"dr__min_{c}"),
                            "max_date": F.col(f"dr__max_{c}"), "non_null_count": F.col(f"dr__n_{c}")}
                           for c in cols])
    return aggs, {}, shape


def _spec_count_pct(name: str, pred: Column) -> Spec:
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))).alias(name), _n().alias("total_rows")]

    def shape(one):
        return one.select(name, "total_rows", _pct_of(name, "total_rows").alias("pct"))
    return aggs, {}, shape


def illogical_pred() -> Column:
    return F.col("date_rptd") < F.col("date_occ")


def _spec_illogical(df: DataFrame, cfg: C.Config) -> Spec:
    return _spec_count_pct("illogical_dates", illogical_pred())


def _spec_lag(df: DataFrame, cfg: C.Config) -> Spec:
    lag = _lag()
    aggs = [F.min(lag).alias("min_days"), F.max(lag).alias("max_days"),
            F.round(F.avg(lag), 4).alias("avg_days"),
            percentile_expr(lag, 0.5, cfg.approx_percentile).alias("median_days"),
            percentile_expr(lag, 0.9, cfg.approx_percentile).alias("p90_days")]
    return aggs, {}, lambda one: one.select("min_days", "max_days", "avg_days", "median_days", "p90_days")


def _spec_time_validity(df: DataFrame, cfg: C.Config) -> Spec:
    t, h, m = F.col("time_occ"), _hour(), _minute()
    aggs = [F.count_if((t < 0) | (t > 2359)).alias("invalid_times"),
            F.count_if((h > 23) | (h < 0)).alias("invalid_hours"),
            F.count_if((m > 59) | (m < 0)).alias("invalid_minutes")]
    return aggs, {}, lambda one: one.select("invalid_times", "invalid_hours", "invalid_minutes")


def _as_of(cfg: C.Config) -> Column:
    return F.lit(cfg.as_of).cast("timestamp_ntz") if cfg.as_of else F.current_timestamp().cast("timestamp_ntz")


def _spec_future(df: DataFrame, cfg: C.Config) -> Spec:
    a = _as_of(cfg)
    aggs = [F.count_if(F.col("date_occ") > a).alias("future_occurrences"),
            F.count_if(F.col("date_rptd") > a).alias("future_reports")]
    return aggs, {}, lambda one: one.select("future_occurrences", "future_reports")


def _spec_coord_stats(df: DataFrame, cfg: C.Config) -> Spec:
    names = ["min_lat", "max_lat", "avg_lat", "min_lon", "max_lon", "avg_lon", "non_null_lat", "non_null_lon"]
    aggs = [F.min("lat").alias("min_lat"), F.max("lat").alias("max_lat"), F.round(F.avg("lat"), 6).alias("avg_lat"),
            F.min("lon").alias("min_lon"), F.max("lon").alias("max_lon"), F.round(F.avg("lon"), 6).alias("avg_lon"),
            F.count("lat").alias("non_null_lat"), F.count("lon").alias("non_null_lon")]
    return aggs, {}, lambda one: one.select(*names)


def _oob(cfg: C.Config) -> tuple[Column, Column]:
    return (X.out_of_range("lat", *cfg.lat_bounds), X.out_of_range("lon", *cfg.lon_bounds))


def _spec_coord_bounds(df: DataFrame, cfg: C.Config) -> Spec:
    lat_bad, lon_bad = _oob(cfg)
    aggs = [F.count_if((F.col("lat") == 0) & (F.col("lon") == 0)).alias("zero_coords"),
            F.count_if(lat_bad).alias("out_of_bounds_lat"), F.count_if(lon_bad).alias("out_of_bounds_lon"),
            F.count_if(lat_bad | lon_bad).alias("out_of_bounds_either"), _n().alias("total_rows")]

    def shape(one):
        return one.select("zero_coords", "out_of_bounds_lat", "out_of_bounds_lon", "out_of_bounds_either",
                          "total_rows", _pct_of("out_of_bounds_either", "total_rows").alias("pct_out_of_bounds"))
    return aggs, {}, shape


def _spec_districts(df: DataFrame, cfg: C.Config) -> Spec:
    aggs = [F.min("rpt_dist_no").alias("min_district"), F.max("rpt_dist_no").alias("max_district")]
    return aggs, {"distinct_districts": "rpt_dist_no"}, \
        lambda one: one.select("distinct_districts", "min_district", "max_district")


def _spec_location(df: DataFrame, cfg: C.Config) -> Spec:
    ln = F.length("location")
    aggs = [F.count("location").alias("non_null_locations"),
            F.min(ln).alias("min_length"), F.max(ln).alias("max_length"),
            F.round(F.avg(ln), 4).alias("avg_length")]
    return aggs, {"unique_locations": "location"}, \
        lambda one: one.select("non_null_locations", "unique_locations", "min_length", "max_length",
                                        "avg_length")


def _spec_age_stats(df: DataFrame, cfg: C.Config) -> Spec:
    a = F.col("vict_age")
    aggs = [F.min(a).alias("min_age"), F.max(a).alias("max_age"), F.round(F.avg(a), 4).alias("avg_age"),
            percentile_expr(a, 0.5, cfg.approx_percentile).alias("median_age"), F.count(a).alias("age_non_null")]
    return aggs, {}, lambda one: one.select("min_age", "max_age", "avg_age", "median_age",
                                        F.col("age_non_null").alias("non_null_count"))


def _invalid_age(cfg: C.Config) -> Column:
    return (F.col("vict_age") < 0) | (F.col("vict_age") > cfg.max_age)


def _spec_age_validity(df: DataFrame, cfg: C.Config) -> Spec:
    a = F.col("vict_age")
    aggs = [F.count_if(a < 0).alias("negative_ages"), F.count_if(a == 0).alias("zero_ages"),
            F.count_if(a > cfg.max_age).alias("over_max_ages"),
            F.count_if(_invalid_age(cfg)).alias("invalid_ages"), _n().alias("total_rows")]

    def shape(one):
        return one.select("negative_ages", "zero_ages", "over_max_ages", "invalid_ages", "total_rows",
                          _pct_of("invalid_ages", "total_rows").alias("pct_invalid"))
    return aggs, {}, shape


def _spec_missing_demo(df: DataFrame, cfg: C.Config) -> Spec:
    pred = F.col("vict_age").isNull() | F.col("vict_sex").isNull() | F.col("vict_descent").isNull()
    return _spec_count_pct("missing_demographics", pred)


def _issue_counters(cfg: C.Config) -> dict[str, Column]:
    lat_bad, lon_bad = _oob(cfg)
    a = F.col("vict_age")
    return {
        "report_before_occurrence": illogical_pred(),
        "out_of_bounds": lat_bad | lon_bad,
        "zero_coords": (F.col("lat") == 0) & (F.col("lon") == 0),
        "negative_ages": a < 0,
        "zero_ages": a == 0,
        "missing_sex_descent": F.col("vict_sex").isNull() | F.col("vict_descent").isNull(),
        "secondary_codes": F.col("crm_cd_2").isNull(),
        "missing_weapons": F.col("weapon_used_cd").isNull(),
    }


def _spec_issues(df: DataFrame, cfg: C.Config) -> Spec:
    aggs = [F.count_if(p).alias(f"issue__{k}") for k, p in _issue_counters(cfg).items()]

    def shape(one):
        return _rows(one, [{"category": F.lit(cat), "issue": F.lit(issue), "count": F.col(f"issue__{key}"),
                            "severity": F.lit(sev), "action": F.lit(act)}
                           for key, cat, issue, sev, act in ISSUES])
    return aggs, {}, shape


def _spec_key_stats(df: DataFrame, cfg: C.Config) -> Spec:
    a = F.col("vict_age")
    distinct_cols = ["crm_cd", "area", "rpt_dist_no", "location"]
    exprs = [
        date_span("date_occ"),
        F.round(F.avg(_lag()), 2),
        F.count("weapon_used_cd"),
        F.count_if(F.col("weapon_used_cd").isNull()),
        F.count_if((a > 0) & (a < 18)),
        F.count_if((a >= 65) & (a < 120)),
    ]
    n_d = len(distinct_cols)
    aggs = [e.alias(f"ks__{i + n_d}") for i, e in enumerate(exprs)]
    distincts = {f"ks__{i}": c for i, c in enumerate(distinct_cols)}

    def shape(one):
        return _rows(one, [{"metric": F.lit(name), "value": F.col(f"ks__{i}").cast("double")}
                           for i, name in enumerate(KEY_METRICS)])
    return aggs, distincts, shape


def _spec_retention(df: DataFrame, cfg: C.Config) -> Spec:
    ok = F.lit(True)
    for text in cfg.rules.values():
        ok = ok & X.rule(text)
    aggs = [_n().alias("total_rows"), F.count_if(~ok).alias("rows_failing")]

    def shape(one):
        kept = F.col("total_rows") - F.col("rows_failing")
        return one.select(F.col("total_rows").alias("rows_in"), "rows_failing", kept.alias("rows_kept"),
                          X.pct(kept, F.col("total_rows")).alias("pct_retained"))
    return aggs, {}, shape


SCALAR_SPECS: dict[str, Callable[[DataFrame, C.Config], Spec]] = {
    "schema_profile": _spec_schema,
    "null_profile": _spec_nulls,
    "completeness": _spec_completeness,
    "date_range": _spec_date_range,
    "illogical_dates": _spec_illogical,
    "lag_stats": _spec_lag,
    "time_validity": _spec_time_validity,
    "future_dates": _spec_future,
    "coordinate_stats": _spec_coord_stats,
    "coordinate_bounds": _spec_coord_bounds,
    "district_stats": _spec_districts,
    "location_stats": _spec_location,
    "age_stats": _spec_age_stats,
    "age_validity": _spec_age_validity,
    "missing_demographics": _spec_missing_demo,
    "issue_summary": _spec_issues,
    "key_stats": _spec_key_stats,
    "retention": _spec_retention,
}


# ================================================================ public scalar reports
def schema_profile(df: DataFrame) -> DataFrame:
    """Column, type, nullability and ordinal, with each column's
    non-null count from one aggregate pass."""
    return _run(df, _spec_schema(df, C.DEFAULT))


def null_profile(df: DataFrame) -> DataFrame:
    """R2: per column: nulls, % nulls, non-nulls, % complete (one pass)."""
    return _run(df, _spec_nulls(df, C.DEFAULT))


def completeness(df: DataFrame) -> DataFrame:
    """Cells, null cells and overall completeness with a letter grade."""
    return _run(df, _spec_completeness(df, C.DEFAULT))


def date_range(df: DataFrame, cols: Sequence[str] = ("date_occ", "date_rptd")) -> DataFrame:
    """Earliest, latest and non-null count per date column."""
    return _run(df, _spec_date_range(df, C.DEFAULT, cols))


def illogical_dates(df: DataFrame) -> DataFrame:
    """Rows reported before they occurred: count and %."""
    return _run(df, _spec_illogical(df, C.DEFAULT))


def lag_stats(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Reporting lag in days: min, max, avg, median and p90 (exact unless
    ``cfg.approx_percentile``)."""
    return _run(df, _spec_lag(df, cfg))


def time_validity(df: DataFrame) -> DataFrame:
    """Times outside 0-2359, parsed hours outside 0-23, minutes outside 0-59."""
    return _run(df, _spec_time_validity(df, C.DEFAULT))


def future_dates(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Occurrences and reports after the as-of date."""
    return _run(df, _spec_future(df, cfg))


def coordinate_stats(df: DataFrame) -> DataFrame:
    """Min / max / avg / non-null of latitude and longitude."""
    return _run(df, _spec_coord_stats(df, C.DEFAULT))


def coordinate_bounds(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Zero pairs; out-of-bounds latitude, longitude, either; % either."""
    return _run(df, _spec_coord_bounds(df, cfg))


def district_stats(df: DataFrame) -> DataFrame:
    """Distinct reporting districts and their range."""
    return _run(df, _spec_districts(df, C.DEFAULT))


def location_stats(df: DataFrame) -> DataFrame:
    """Non-null and distinct locations; text length min / max / avg."""
    return _run(df, _spec_location(df, C.DEFAULT))


def age_stats(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Raw victim age: min, max, avg, median (exact unless
    ``cfg.approx_percentile``), non-null."""
    return _run(df, _spec_age_stats(df, cfg))


def age_validity(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Negative, zero, above max and invalid ages, with % invalid."""
    return _run(df, _spec_age_validity(df, cfg))


def missing_demographics(df: DataFrame) -> DataFrame:
    """Rows missing any of age, sex or descent."""
    return _run(df, _spec_missing_demo(df, C.DEFAULT))


def issue_summary(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """The quality issue catalogue with counts computed from the data."""
    return _run(df, _spec_issues(df, cfg))


def key_stats(df: DataFrame) -> DataFrame:
    """Headline metrics of the dataset, computed in one aggregate."""
    return _run(df, _spec_key_stats(df, C.DEFAULT))


def retention(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Rows in, rows failing any rule, rows kept, % retained."""
    return _run(df, _spec_retention(df, cfg))


# ================================================================ samples (T4)
def illogical_dates_sample(df: DataFrame, k: int = 10) -> DataFrame:
    """R6 sample: first ``k`` offending rows by dr_no."""
    return sample_violations(df, illogical_pred(), ["dr_no", "date_rptd", "date_occ", "crm_cd_desc"], k)


def future_dates_sample(df: DataFrame, cfg: C.Config = C.DEFAULT, k: int = 10) -> DataFrame:
    """R11 sample: first ``k`` future occurrences by dr_no."""
    return sample_violations(df, F.col("date_occ") > _as_of(cfg),
                             ["dr_no", "date_occ", "date_rptd", "crm_cd_desc"], k)


def coordinate_bounds_sample(df: DataFrame, cfg: C.Config = C.DEFAULT, k: int = 10) -> DataFrame:
    """R13 sample."""
    lat_bad, lon_bad = _oob(cfg)
    return sample_violations(df, lat_bad | lon_bad, ["dr_no", "lat", "lon", "location", "area_name"], k)


def age_validity_sample(df: DataFrame, cfg: C.Config = C.DEFAULT, k: int = 10) -> DataFrame:
    """R20 sample."""
    return sample_violations(df, _invalid_age(cfg),
                             ["dr_no", "vict_age", "vict_sex", "vict_descent", "crm_cd_desc"], k)


# ================================================================ grouped reports
# Grouping keys shared by the grouped reports (alias -> expression).
def _group_keys() -> dict[str, Column]:
    return {
        "days_to_report": _lag(),
        "hour": _hour(),
        "area": F.col("area"),
        "area_name": F.col("area_name"),
        "rpt_dist_no": F.col("rpt_dist_no"),
        "age_group": X.raw_age_band("vict_age"),
        "vict_sex": F.col("vict_sex"),
        "vict_descent": F.col("vict_descent"),
    }


GROUPINGS: dict[str, list[str]] = {
    "lag": ["days_to_report"],
    "hour": ["hour"],
    "area": ["area", "area_name"],
    "district": ["rpt_dist_no"],
    "age": ["age_group"],
    "sex": ["vict_sex"],
    "descent": ["vict_descent"],
    "profile": ["age_group", "vict_sex", "vict_descent"],
}


def _counts(df: DataFrame, grouping: str) -> DataFrame:
    keys = _group_keys()
    cols = GROUPINGS[grouping]
    return value_counts(df.select(*[keys[c].alias(c) for c in cols]), cols, CNT)


def _lag_distribution(counts: DataFrame, k: int = 20) -> DataFrame:
    return first_k(counts, "days_to_report", k)


def _invalid_areas(counts: DataFrame) -> DataFrame:
    return counts.filter(~F.col("area").isin(list(C.VALID_AREAS)))


def _top_districts(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k(counts, ["rpt_dist_no"], k, CNT)


def _sex_distribution(counts: DataFrame) -> DataFrame:
    s = F.col("vict_sex")
    return _with_share(counts).withColumn("is_expected", s.isNull() | s.isin(C.PROFILE_SEX_CODES))


def _descent_distribution(counts: DataFrame) -> DataFrame:
    d = F.col("vict_descent")
    known = list(C.PROFILE_DESCENT_CODES)
    return _with_share(counts).withColumns({
        "descent_desc": F.when(d.isin(known), X.code_label(d, C.PROFILE_DESCENT_CODES, "")),
        "is_expected": d.isNull() | d.isin(known),
    })


def _top_profiles(counts: DataFrame, k: int = 10) -> DataFrame:
    return top_k(counts, GROUPINGS["profile"], k, CNT)


# report -> (grouping, shape of the per-group counts)
GROUPED_REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "lag_distribution": ("lag", _lag_distribution),
    "hour_distribution": ("hour", lambda c: c),
    "area_distribution": ("area", lambda c: c),
    "invalid_areas": ("area", _invalid_areas),
    "top_districts": ("district", _top_districts),
    "age_distribution_raw": ("age", lambda c: c),
    "sex_distribution": ("sex", _sex_distribution),
    "descent_distribution": ("descent", _descent_distribution),
    "top_profiles": ("profile", _top_profiles),
}


def lag_distribution(df: DataFrame, k: int = 20) -> DataFrame:
    """Row count per lag value, the first ``k`` lags ascending."""
    return _lag_distribution(_counts(df, "lag"), k)


def hour_distribution(df: DataFrame) -> DataFrame:
    """Row count per parsed hour."""
    return _counts(df, "hour")


def area_distribution(df: DataFrame) -> DataFrame:
    """Rows per area."""
    return _counts(df, "area")


def invalid_areas(df: DataFrame) -> DataFrame:
    """Areas outside 1-21 (NULL not counted), with row counts."""
    return _invalid_areas(_counts(df, "area"))


def top_districts(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` districts with most rows."""
    return _top_districts(_counts(df, "district"), k)


def age_distribution_raw(df: DataFrame) -> DataFrame:
    """Rows per profiling age band (differs from the silver bands)."""
    return _counts(df, "age")


def sex_distribution(df: DataFrame) -> DataFrame:
    """Rows and % per sex code; whether the code is an expected one."""
    return _sex_distribution(_counts(df, "sex"))


def descent_distribution(df: DataFrame) -> DataFrame:
    """Rows and % per descent code, its description and whether known."""
    return _descent_distribution(_counts(df, "descent"))


def top_profiles(df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most common (profiling age band, sex, descent) profiles."""
    return _top_profiles(_counts(df, "profile"), k)


# ================================================================ R4 distinct profile
def _cardinality_class(ratio: Column) -> Column:
    expr = None
    for lo, label in C.CARDINALITY_CLASSES:
        expr = F.when(ratio > lo, label) if expr is None else expr.when(ratio > lo, label)
    return expr.otherwise(C.CARDINALITY_CLASS_LAST)


def _distinct_text(col: Column, dtype: T.DataType) -> Column:
    """An exact text form for distinct counting: -0.0 folds into 0.0 (as in
    Spark's own grouping), binary is base64, nested types are JSON."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        col = F.when(col == 0, F.lit(0.0).cast(dtype)).otherwise(col)
    if isinstance(dtype, T.BinaryType):
        return F.base64(col)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")


def _distinct_counts(df: DataFrame, approx: bool = False, approx_columns: Sequence[str] = ()) -> DataFrame:
    """Per column: distinct values counting NULL as a value, distinct
    non-null values, and the row count (one pass over ``df`` per mode).

    Exact columns go through the stacked (column, value) pass; columns in
    ``approx_columns`` (or all, with ``approx``) use HyperLogLog++ sketches,
    which never shuffle the values themselves - the right choice for
    identifier-like columns whose exact distinct count would move the whole
    column across the network.
    """
    fields = df.schema.fields
    sketched = [f.name for f in fields if approx or f.name in set(approx_columns)]
    exact = [f for f in fields if f.name not in set(sketched)]
    parts = []
    if sketched:
        one = df.agg(_n().alias("__n"),
                     *[distinct_with_null(f"`{c}`", True).alias(f"d__{c}") for c in sketched],
                     *[F.approx_count_distinct(_q(c)).alias(f"nn__{c}") for c in sketched])
        parts.append(_rows(one, [{"column_name": F.lit(c), "distinct_count": _q(f"d__{c}"),
                                  "distinct_non_null": _q(f"nn__{c}"), "__n": F.col("__n")} for c in sketched]))
    if exact:
        pairs = F.explode(F.array(*[
            F.struct(F.lit(f.name).alias("column_name"), _distinct_text(_q(f.name), f.dataType).alias("v"))
            for f in exact]))
        per_value = (df.select(pairs.alias("p")).select("p.column_name", "p.v")
                     .groupBy("column_name", "v").agg(_n().alias("rows")))
        parts.append(per_value.groupBy("column_name").agg(
            _n().alias("distinct_count"), F.count("v").alias("distinct_non_null"), F.sum("rows").alias("__n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _cardinality_report(per_column: DataFrame) -> DataFrame:
    raw = F.col("distinct_count").cast("double") * 100.0 / F.col("__n")
    return per_column.select(
        "column_name", "distinct_count", F.col("__n").alias("total_records"),
        F.round(raw, 2).alias("cardinality_ratio_pct"), _cardinality_class(raw).alias("category"))


def cardinality_profile(df: DataFrame, approx: bool = False, approx_columns: Sequence[str] = ()) -> DataFrame:
    """Distinct values per column (NULL counted as a value), ratio to the
    row count and a cardinality class.

    Exact mode stacks every row into narrow (column, value) pairs and groups
    them twice: first by (column, value) - partial aggregation collapses
    repeated values, hot ones included, inside each task - then by column.
    One scan, narrow shuffle keys, and the row count comes from the same
    pass. (A multi-``count_distinct`` aggregate would instead expand every
    row once per column with all columns as grouping keys.) Approx mode uses
    HyperLogLog++ sketches, for all columns or only ``approx_columns``.
    """
    return _cardinality_report(_distinct_counts(df, approx, approx_columns))


# ================================================================ fused profile
def _grouping_id(cols: list[str], present: list[str]) -> int:
    n = len(cols)
    return sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in present)


class ProfileReports(dict):
    """Report name -> DataFrame, plus ``release()`` to unpersist the shared
    intermediate results once the reports have been used."""

    def __init__(self, *args, cached: list[DataFrame] | None = None, **kw):
        super().__init__(*args, **kw)
        self.cached = cached if cached is not None else []

    def release(self) -> None:
        for df in self.cached:
            df.unpersist()
        self.cached = []


def profile_all(df: DataFrame, cfg: C.Config = C.DEFAULT, approx_distinct: bool | None = None,
                persist: bool = True) -> ProfileReports:
    """Every report of R1-R28 from three passes over ``df``, and the four samples.

    * one aggregate with the counters of all scalar reports (identical
      aggregate expressions are computed once);
    * one ``GROUPING SETS`` aggregate for all grouped distributions (each
      row is expanded once per grouping set and pre-aggregated per task);
    * the stacked distinct-count pass of R4.

    The small intermediate results are persisted so every report projects
    from them instead of rescanning ``df``; ``release()`` on the returned
    mapping unpersists them. Reports are returned lazily.
    """
    specs = {name: fn(df, cfg) for name, fn in SCALAR_SPECS.items()}
    approx = cfg.approx_distinct if approx_distinct is None else approx_distinct
    per_column = _distinct_counts(df, approx, cfg.approx_distinct_columns)
    cached: list[DataFrame] = []
    if persist:
        per_column = per_column.persist()
        cached.append(per_column)
    out = ProfileReports({"cardinality_profile": _cardinality_report(per_column)}, cached=cached)

    all_aggs = [a for spec_aggs, _, _ in specs.values() for a in spec_aggs]
    distincts: dict[str, str] = {}
    for _, spec_distincts, _ in specs.values():
        distincts.update(spec_distincts)
    # Output names come from one analysis of all aggregates (no job runs);
    # the same name always denotes the same expression, so keep the first.
    aggs: dict[str, Column] = {}
    for name, a in zip(df.agg(*all_aggs).columns, all_aggs):
        aggs.setdefault(name, a)
    one = df.agg(*aggs.values())
    # Distinct counts come from the stacked pass (scalar subqueries), so the
    # scalar aggregate needs no distinct-aggregate expansion.
    one = one.select("*", *[
        per_column.filter(F.col("column_name") == c).select("distinct_non_null").scalar().alias(n)
        for n, c in distincts.items()])
    if persist:
        one = one.persist()
        cached.append(one)
    out.update({name: shape(one) for name, (_, _, shape) in specs.items()})

    keys = _group_keys()
    cols = list(keys)
    sets = list(GROUPINGS.values())
    grouped = (df.select(*[e.alias(c) for c, e in keys.items()])
               .groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
               .agg(_n().alias(CNT), F.grouping_id().alias("__gid")))
    if persist:
        grouped = grouped.persist()
        cached.append(grouped)
    for report, (grouping, shape) in GROUPED_REPORTS.items():
        present = GROUPINGS[grouping]
        counts = grouped.filter(F.col("__gid") == _grouping_id(cols, present)).select(*present, CNT)
        out[report] = shape(counts)
    # The samples are top-k scans of their own: they show whole rows.
    out["illogical_dates_sample"] = illogical_dates_sample(df)
    for name, fn in (("future_dates_sample", future_dates_sample), ("coordinate_bounds_sample", coordinate_bounds_sample),
                     ("age_validity_sample", age_validity_sample)):
        out[name] = fn(df, cfg)
    return out
