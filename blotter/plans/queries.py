"""Registered queries: one per operator of the inventory.

Every query reads the driver tables (orders, customer, nation) through the
``incidents`` view and runs over the whole input. Audit timestamps are left
out of the outputs so results are comparable across runs and engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import surrogate_key
from ..operators import dims as D
from ..operators import marts as M
from ..operators import profile as R
from ..operators import profile_state as P
from ..operators import quality as Q
from ..operators import silver as S
from ..operators import exact as X
from ..operators.fact import AUDIT_COLUMNS, STAR_ROLES, fact_null_fk_counts
from ..sources import drift
from ..sources.csv import with_ingest_audit
from ..sources.fixture import incidents, read_driver_table
from ..sources.schema import SOURCE_COLUMNS
from ..sources.tables import Layout, append_flow, materialize, read_table
from ..streaming import grain, late, refresh
from ..streaming.flows import run_flows
from .execution import shared_folder
from .pipeline import Layers, bronze_from_fixture, read_layers, run_batch

# Key mode md5 is reproducible in any SQL engine; as-of fixed for R11.
CFG = C.Config(key_mode="md5", as_of="2026-01-01")
# Few enough keys for thousands of incidents to collide (Q7).
COLLIDING_MODULUS = 9_973

Query = Callable[[SparkSession, str], DataFrame]
_TS_COLS = {"ingestion_datetime", "silver_processed_datetime", "created_date", *AUDIT_COLUMNS}


def _drop_ts(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in _TS_COLS])


# Folder of the written layers by (application, state of the input files,
# config): later star queries read the same tables. Changed files under the
# same path, or another application, write their own.
_WRITTEN: dict[tuple, str] = {}


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and time of every file the incidents view reads."""
    state = None
    for name in ("orders", "customer", "nation"):
        files = read_driver_table(spark, sf_dir, name).select(
            "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        state = files if state is None else state.unionByName(files)
    return tuple(sorted(tuple(map(str, r)) for r in state.collect()))


def _layers(spark: SparkSession, sf_dir: str, cfg: C.Config = CFG) -> Layers:
    key = (spark.sparkContext.applicationId, _input_state(spark, sf_dir), repr(cfg))
    if key not in _WRITTEN:
        base = shared_folder(spark, "layers")
        run_batch(spark, Layout(base), bronze_from_fixture(spark, sf_dir), cfg)
        _WRITTEN[key] = base
    return read_layers(spark, Layout(_WRITTEN[key]))


def _flows(spark: SparkSession, sf_dir: str, cfg: C.Config = CFG) -> Layout:
    """The incidents written as CSV files to the shared folder and streamed in
    from there by every flow (X1-X6); run once per application and input."""
    key = (spark.sparkContext.applicationId, "flows", _input_state(spark, sf_dir), repr(cfg))
    if key not in _WRITTEN:
        base = shared_folder(spark, "flows")
        incidents(spark, sf_dir).write.option("header", True).csv(f"{base}/input")
        run_flows(spark, Layout(f"{base}/tables", f"{base}/checkpoints"), f"{base}/input", cfg)
        _WRITTEN[key] = base
    base = _WRITTEN[key]
    return Layout(f"{base}/tables", f"{base}/checkpoints")


def q_flows_fact(spark, sf_dir):
    return _drop_ts(read_table(spark, _flows(spark, sf_dir).path(C.FACT)))


def q_flows_dim_location(spark, sf_dir):
    return _drop_ts(read_table(spark, _flows(spark, sf_dir).path("dim_location")))


def q_flows_layer_rows(spark, sf_dir):
    """Rows per table of the streamed run: bronze = silver + quarantine."""
    layout, out = _flows(spark, sf_dir), None
    for label, name in (("bronze", C.BRONZE), ("silver", C.SILVER), ("quarantine", C.QUARANTINE), ("fact", C.FACT)):
        one = read_table(spark, layout.path(name)).agg(F.lit(label).alias("layer"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


def _silver(spark: SparkSession, sf_dir: str, cfg: C.Config = CFG) -> DataFrame:
    return S.silver(bronze_from_fixture(spark, sf_dir), cfg)


# ---------------------------------------------------------------- E / Q
def _bronze_step(fn) -> Query:
    def q(spark, sf_dir):
        df = fn(incidents(spark, sf_dir), CFG)
        new = [c for c in df.columns if c not in SOURCE_COLUMNS]
        return df.select("dr_no", *new)
    return q


def q_silver(spark, sf_dir):
    return _drop_ts(_silver(spark, sf_dir))


def q_stream_silver(spark, sf_dir):
    """X1/X2/X5 on Structured Streaming: the orders table read as a file
    stream, joined to static customer/nation, gated and enriched, written by
    a Parquet file sink with its own checkpoint (availableNow), read back."""
    root = shared_folder(spark, "stream-silver")
    orders_path = f"{sf_dir.rstrip('/')}/orders.parquet"
    stream = (spark.readStream.schema(spark.read.parquet(orders_path).schema)
              .option("pathGlobFilter", "orders.parquet").parquet(sf_dir))
    bronze = with_ingest_audit(incidents(spark, sf_dir, orders=stream), source="incidents")
    q = append_flow(S.silver(bronze, CFG), f"{root}/silver", f"{root}/_checkpoint", name=None)
    q.awaitTermination()
    return _drop_ts(read_table(spark, f"{root}/silver"))


def q_expect_drop(spark, sf_dir):
    return Q.expect_all_or_drop(incidents(spark, sf_dir), CFG.rules)


def q_expectation_metrics(spark, sf_dir):
    return Q.expectation_metrics(incidents(spark, sf_dir), CFG.rules)


def q_quarantine(spark, sf_dir):
    return Q.quarantine(incidents(spark, sf_dir), CFG.rules)


def q_unexpected_values(spark, sf_dir):
    return Q.unexpected_values(incidents(spark, sf_dir), "vict_descent", list(C.PROFILE_DESCENT_CODES))


def q_orphan_keys(spark, sf_dir):
    """Q5 for every foreign key of the fact against its dimension, in one pass."""
    L = _layers(spark, sf_dir)
    return Q.orphan_keys(L.fact, {fk: (L.dims[dim], dk) for dim, fk, dk, _ in STAR_ROLES.values()})


def q_duplicate_keys(spark, sf_dir):
    """Q6 on the incident grain of the raw input (dr_no; NULL is a key value)."""
    return Q.duplicate_keys(incidents(spark, sf_dir), ["dr_no"])


def q_duplicate_districts(spark, sf_dir):
    """Q6 on a key that is not unique: area and reporting district."""
    return Q.duplicate_keys(incidents(spark, sf_dir), ["area", "rpt_dist_no"])


def _collision_summary(spark, sf_dir, cfg: C.Config) -> DataFrame:
    L = _layers(spark, sf_dir, cfg)
    out = None
    for name, (key, natural) in D.NATURAL_KEYS.items():
        one = Q.key_collision_summary(L.dims[name], key, natural, name)
        out = one if out is None else out.unionByName(one)
    return out


def q_key_collisions(spark, sf_dir):
    return _collision_summary(spark, sf_dir, CFG)


def q_incident_key_collisions(spark, sf_dir):
    """Q7 where keys do collide: incident keys reduced to a small modulus."""
    keyed = incidents(spark, sf_dir).select("dr_no", surrogate_key(F.col("dr_no"), COLLIDING_MODULUS, "md5").alias("key"))
    return Q.key_collisions(keyed, "key", ["dr_no"])


# ---------------------------------------------------------------- D / G
def _usage(spark, sf_dir, cfg: C.Config) -> DataFrame:
    """D1 with the number of incidents that occurred and were reported per day."""
    return M.calendar_usage(_silver(spark, sf_dir, cfg), D.dim_date(spark, cfg))


def q_dim_date(spark, sf_dir):
    return _usage(spark, sf_dir, CFG)


def q_fiscal_july(spark, sf_dir):
    return _usage(spark, sf_dir, CFG.with_(fiscal_start_month=7))


def q_dim_time(spark, sf_dir):
    """D2 with the number of incidents per minute of the day."""
    return M.time_usage(_silver(spark, sf_dir), _drop_ts(D.dim_time(spark, CFG)))


def _dim(name: str, cfg: C.Config = CFG) -> Query:
    def q(spark, sf_dir):
        return _drop_ts(D.DATA_DIMS[name](_silver(spark, sf_dir, cfg), cfg))
    return q


def q_fact(spark, sf_dir):
    return _drop_ts(_layers(spark, sf_dir).fact)


def q_fact_null_fk_counts(spark, sf_dir):
    return fact_null_fk_counts(_layers(spark, sf_dir).fact)


def q_crime_category(spark, sf_dir):
    cfg = CFG.with_(crime_category=True)
    return _drop_ts(D.dim_crime_type(_silver(spark, sf_dir, cfg), cfg))


def q_out_of_bounds_flag(spark, sf_dir):
    df = D.out_of_bounds_flag(_silver(spark, sf_dir), CFG)
    return df.select("dr_no", "lat", "lon", "lat_clean", "lon_clean", "is_out_of_bounds")


# ---------------------------------------------------------------- R
def _profile(fn, *args) -> Query:
    def q(spark, sf_dir):
        return fn(incidents(spark, sf_dir), *args)
    return q


def _profile_table(fn, table: str) -> Query:
    def q(spark, sf_dir):
        return fn(spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))
    return q


# ---------------------------------------------------------------- B / U
def _mart(name: str, cfg: C.Config = CFG) -> Query:
    fn, roles = M.MARTS[name]

    def q(spark, sf_dir):
        L = _layers(spark, sf_dir, cfg)
        star = L.star(roles, cfg)
        return fn(star, cfg) if name == "density_grid" else fn(star)
    return q


def q_layer_counts(spark, sf_dir):
    L = _layers(spark, sf_dir)
    return M.layer_counts(L.bronze, L.silver, L.fact)


# ---------------------------------------------------------------- across runs
def q_late_members_fact(spark, sf_dir):
    """X4 where members come after their facts: the first run's facts meet the
    members of a part of its rows only; the others are added later."""
    L, layout = _layers(spark, sf_dir), Layout(shared_folder(spark, "late"))
    early = dict(L.dims)
    for name, build in D.DATA_DIMS.items():
        materialize(build(L.silver.filter("dr_no % 4 = 0"), CFG), layout.path(name))
        early[name] = read_table(spark, layout.path(name))
    late.append_facts(L.silver.filter("dr_no % 2 = 0"), early, layout, 1, CFG)
    late.rekey_late(spark, layout, {name: late.new_members(L.dims[name], early[name], name) for name in D.DATA_DIMS}, CFG)
    late.append_facts(L.silver.filter("dr_no % 2 <> 0"), L.dims, layout, 2, CFG, sizes=L.sizes)
    return _drop_ts(late.maintained_fact(spark, layout))


def q_settled_locations(spark, sf_dir):
    """A12/X3 over three runs whose rows differ in the members' payload."""
    layout, silver = Layout(shared_folder(spark, "settled")), _layers(spark, sf_dir).silver
    third = F.col("dr_no") % 3
    silver = silver.withColumn("area_name", F.when(third == 1, F.lower("area_name")).when(third == 0, F.col("area_name")))
    for version in (2, 1, 0):
        late.settle_members(silver.filter(third == version), "dim_location", layout, version)
    return _drop_ts(late.settled_dimension(spark, layout, "dim_location", CFG))


def q_unique_incidents(spark, sf_dir):
    """Q6 enforced over two runs: the second repeats incidents of the first and
    has some of its own twice."""
    layout, rows = Layout(shared_folder(spark, "grain")), incidents(spark, sf_dir)
    again = rows.filter("dr_no % 10 = 0").withColumn("status", F.lit("again"))
    fresh = (rows.filter("dr_no % 10 = 1 and date_rptd is not null").withColumn("dr_no", -F.col("dr_no"))
             .withColumn("status", F.lit("fresh")))
    later = fresh.withColumn("date_rptd", F.expr("date_rptd + interval 1 day")).withColumn("status", F.lit("later"))
    grain.enforce_grain(rows, layout, 0)
    grain.enforce_grain(again.unionByName(later).unionByName(fresh), layout, 1)
    kept = read_table(spark, layout.path(grain.UNIQUE)).select("dr_no", "status", F.lit("kept").alias("outcome"))
    return kept.unionByName(read_table(spark, layout.path(grain.REPEATED)).select("dr_no", "status", F.col("failed_rules").alias("outcome")))


def _refreshed(spark: SparkSession, sf_dir: str) -> Layout:
    """Cubes after five deltas: a run whose members come late, their keys, a second
    run, a run that repeats some facts, and its withdrawal."""
    key = (spark.sparkContext.applicationId, "refreshed", _input_state(spark, sf_dir), repr(CFG))
    if key not in _WRITTEN:
        L, layout = _layers(spark, sf_dir), Layout(shared_folder(spark, "refreshed"))
        early = {**L.dims, **{name: L.dims[name].filter(F.pmod(F.xxhash64(F.col(D.NATURAL_KEYS[name][0])), F.lit(4)) != 0)
                              for name in D.DATA_DIMS}}

        def run_facts(run):
            return read_table(spark, layout.path(late.FACT)).filter(F.col("run") == run)

        late.append_facts(L.silver.filter("dr_no % 2 = 0"), early, layout, 1, CFG)
        refresh.write_delta(layout, 1, run_facts(1))
        late.rekey_late(spark, layout, {name: late.new_members(L.dims[name], early[name], name) for name in D.DATA_DIMS}, CFG,
                        on_change=refresh.rekeyed_delta(layout, 1))
        late.append_facts(L.silver.filter("dr_no % 2 <> 0"), L.dims, layout, 2, CFG, sizes=L.sizes)
        refresh.write_delta(layout, 2, run_facts(2))
        again = L.fact.filter("dr_no % 5 = 0")
        refresh.write_delta(layout, 3, again)
        refresh.write_delta(layout, 3, removed=again, change=refresh.WITHDRAWN)
        _WRITTEN[key] = layout.base
    return Layout(_WRITTEN[key])


def _refreshed_mart(name: str) -> Query:
    def q(spark, sf_dir):
        L = _layers(spark, sf_dir)
        return refresh.refreshed_mart(spark, _refreshed(spark, sf_dir), name, L.dims, CFG, L.sizes)
    return q


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidents as CSV files of four layouts, streamed in file by file and
    reconciled: columns in another order; two left out and one added; one renamed
    and one with text among its numbers; whole numbers as fractions."""
    key = (spark.sparkContext.applicationId, "drifted", _input_state(spark, sf_dir))
    if key not in _WRITTEN:
        base, rows = shared_folder(spark, "drifted"), incidents(spark, sf_dir)
        part = F.coalesce(F.col("dr_no") % 4, F.lit(0))
        layouts = [
            lambda df: df.select(*reversed(df.columns)),
            lambda df: df.drop("mocodes", "cross_street").withColumn("Beat No", F.concat(F.lit("B"), "area")),
            lambda df: (df.withColumn("vict_age", F.when(F.col("area") == 3, "30+").otherwise(F.col("vict_age").cast("string")))
                        .withColumnRenamed("crm_cd_desc", "Crime Description")),
            lambda df: df.withColumns({"area": F.col("area").cast("double"), "lat": F.when(F.col("lat") == 0, "n/a").otherwise(F.col("lat").cast("string"))}),
        ]
        for i, shape in enumerate(layouts):
            shape(rows.filter(part == i)).write.mode("append").option("header", True).csv(f"{base}/input")
        drift.reconciled_flow(spark, Layout(f"{base}/tables", f"{base}/checkpoints"), f"{base}/input",
                              aliases={"crime_description": "crm_cd_desc"}).awaitTermination()
        _WRITTEN[key] = base
    return read_table(spark, Layout(f"{_WRITTEN[key]}/tables").path(drift.RECONCILED))


def q_drifted_incidents(spark, sf_dir):
    """Every row of the drifted files, with the cells that have no column."""
    cells = F.array_join(F.transform(F.array_sort(F.map_entries(drift.RESCUED)), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return _drifted(spark, sf_dir).select(*SOURCE_COLUMNS, cells.alias("rescued_cells"), drift.CORRUPT)


def q_drift_report(spark, sf_dir):
    return drift.drift_report(_drifted(spark, sf_dir))


# Reports that between them use every kind of merged state.
MERGED_REPORTS = ("lag_stats", "age_stats", "coordinate_stats", "location_stats", "district_stats", "key_stats", "issue_summary",
                  "null_profile", "date_range", "top_profiles", "illogical_dates_sample")
# The incidents as the profile states read them.
PROFILED = "incidents_profiled"
# Ten standard errors of a sketch and one value.
SKETCH_ERROR = 10 * 1.04 / 2 ** (P.LG_K / 2)


def _states(spark: SparkSession, sf_dir: str) -> tuple[Layout, DataFrame]:
    """Profile states of the incidents in three batches of uneven size."""
    key = (spark.sparkContext.applicationId, "states", _input_state(spark, sf_dir), repr(CFG))
    if key not in _WRITTEN:
        layout, part = Layout(shared_folder(spark, "states")), F.coalesce(F.col("dr_no") % 10, F.lit(0))
        # Every state scans its batch: the view's joins are done once, not for each.
        materialize(incidents(spark, sf_dir), layout.path(PROFILED))
        rows = read_table(spark, layout.path(PROFILED))
        for batch, share in enumerate((part < 6, (part >= 6) & (part < 9), part == 9)):
            P.write_states(rows.filter(share), layout, batch, CFG)
        _WRITTEN[key] = layout.base
    layout = Layout(_WRITTEN[key])
    return layout, read_table(spark, layout.path(PROFILED))


def _merged_report(name: str) -> Query:
    def q(spark, sf_dir):
        layout, rows = _states(spark, sf_dir)
        return P.merged_profile(spark, layout, rows.schema, CFG)[name]
    return q


def q_sketched_cardinality(spark, sf_dir):
    """Distinct counts by united sketches, held against the exact ones."""
    layout, rows = _states(spark, sf_dir)
    exact = R.cardinality_profile(rows).select("column_name", F.col("distinct_count").alias("exact_count"), "total_records")
    off = F.abs(F.col("distinct_count") - F.col("exact_count"))
    return (exact.join(P.sketched_distinct(spark, layout), "column_name")
            .select("column_name", "exact_count", "total_records", (off <= F.col("exact_count") * SKETCH_ERROR + 1).alias("within_error")))


QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)


def q_exact_quantiles(spark, sf_dir):
    """A5 on a column of mostly distinct values and on one of few."""
    rows, out = read_driver_table(spark, sf_dir, "lineitem"), None
    for c in ("l_extendedprice", "l_quantity"):
        one = X.exact_quantiles(rows, c, QUANTILES).select(F.lit(c).alias("column_name"), "prob", F.round("value", 6).alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def q_proven_top(spark, sf_dir):
    """T2 on keys of similar frequency and on skewed ones."""
    rows = read_driver_table(spark, sf_dir, "lineitem")
    skewed = rows.select(F.floor(F.sqrt(F.sqrt("l_partkey"))).cast("long").alias("k"))
    return (X.proven_top_k(rows, "l_partkey", 25).select(F.lit("l_partkey").alias("column_name"), "key", "count")
            .unionByName(X.proven_top_k(skewed, "k", 5).select(F.lit("root").alias("column_name"), "key", "count")))


def q_dense_location_keys(spark, sf_dir):
    """G1/Q7: keys of the second run follow those of the first."""
    silver, path = _layers(spark, sf_dir).silver, shared_folder(spark, "registry")
    X.register_keys(silver.filter("dr_no % 3 = 0 and area is not null"), ["area", "rpt_dist_no"], path, 1)
    return X.register_keys(silver.filter("area is not null"), ["area", "rpt_dist_no"], path, 2)


GRID_LEVELS = (0, 4, 8, 10, 12)


def q_grid_levels(spark, sf_dir):
    return X.grid_levels(_layers(spark, sf_dir).fact, GRID_LEVELS)


def registry() -> dict[str, Query]:
    q: dict[str, Query] = {
        "clean_age": _bronze_step(S.clean_age),
        "clean_coords": _bronze_step(S.clean_coords),
        "age_group": _bronze_step(S.age_group),
        "time_parts": _bronze_step(S.time_parts),
        "time_period": _bronze_step(S.time_period),
        "days_to_report": _bronze_step(S.days_to_report),
        "incident_flags": _bronze_step(S.incident_flags),
        "silver": q_silver,
        "stream_silver": q_stream_silver,
        "flows_fact": q_flows_fact,
        "flows_dim_location": q_flows_dim_location,
        "flows_layer_rows": q_flows_layer_rows,
        "expect_drop": q_expect_drop,
        "expectation_metrics": q_expectation_metrics,
        "quarantine": q_quarantine,
        "unexpected_values": q_unexpected_values,
        "orphan_keys": q_orphan_keys,
        "duplicate_keys": q_duplicate_keys,
        "duplicate_districts": q_duplicate_districts,
        "key_collisions": q_key_collisions,
        "incident_key_collisions": q_incident_key_collisions,
        "dim_date": q_dim_date,
        "dim_time": q_dim_time,
        "dim_status": _dim("dim_status"),
        "dim_location": _dim("dim_location"),
        "dim_premise": _dim("dim_premise"),
        "dim_weapon": _dim("dim_weapon"),
        "dim_crime_type": _dim("dim_crime_type"),
        "dim_victim": _dim("dim_victim_demographics"),
        "fact_incidents": q_fact,
        "fact_null_fk_counts": q_fact_null_fk_counts,
        "schema_profile": _profile(R.schema_profile),
        "null_profile": _profile(R.null_profile),
        "null_profile_orders": _profile_table(R.null_profile, "orders"),
        "completeness": _profile(R.completeness),
        "completeness_orders": _profile_table(R.completeness, "orders"),
        "null_profile_events": _profile_table(R.null_profile, "events"),
        "cardinality_profile_orders": _profile_table(R.cardinality_profile, "orders"),
        "cardinality_profile": _profile(R.cardinality_profile),
        "cardinality_profile_events": _profile_table(R.cardinality_profile, "events"),
        "date_range": _profile(R.date_range),
        "illogical_dates": _profile(R.illogical_dates),
        "illogical_dates_sample": _profile(R.illogical_dates_sample),
        "lag_stats": _profile(R.lag_stats),
        "lag_distribution": _profile(R.lag_distribution),
        "time_validity": _profile(R.time_validity),
        "hour_distribution": _profile(R.hour_distribution),
        "future_dates": _profile(R.future_dates, CFG),
        "future_dates_sample": _profile(R.future_dates_sample, CFG),
        "coordinate_stats": _profile(R.coordinate_stats),
        "coordinate_bounds": _profile(R.coordinate_bounds, CFG),
        "coordinate_bounds_sample": _profile(R.coordinate_bounds_sample, CFG),
        "area_distribution": _profile(R.area_distribution),
        "invalid_areas": _profile(R.invalid_areas),
        "district_stats": _profile(R.district_stats),
        "top_districts": _profile(R.top_districts),
        "location_stats": _profile(R.location_stats),
        "age_stats": _profile(R.age_stats),
        "age_validity": _profile(R.age_validity, CFG),
        "age_validity_sample": _profile(R.age_validity_sample, CFG),
        "age_distribution_raw": _profile(R.age_distribution_raw),
        "sex_distribution": _profile(R.sex_distribution),
        "descent_distribution": _profile(R.descent_distribution),
        "missing_demographics": _profile(R.missing_demographics),
        "top_profiles": _profile(R.top_profiles),
        "issue_summary": _profile(R.issue_summary, CFG),
        "key_stats": _profile(R.key_stats),
        "retention": _profile(R.retention, CFG),
    }
    for name in M.MARTS:
        q[name] = _mart(name)
        q[f"refreshed_{name}"] = _refreshed_mart(name)
    q["layer_counts"] = q_layer_counts
    q["late_members_fact"] = q_late_members_fact
    q["settled_locations"] = q_settled_locations
    q["unique_incidents"] = q_unique_incidents
    q["drifted_incidents"] = q_drifted_incidents
    q["drift_report"] = q_drift_report
    for name in MERGED_REPORTS:
        q[f"merged_{name}"] = _merged_report(name)
    q["sketched_cardinality"] = q_sketched_cardinality
    q["exact_quantiles"] = q_exact_quantiles
    q["proven_top"] = q_proven_top
    q["dense_location_keys"] = q_dense_location_keys
    q["grid_levels"] = q_grid_levels
    q["crime_category"] = q_crime_category
    q["out_of_bounds_flag"] = q_out_of_bounds_flag
    q["fiscal_july"] = q_fiscal_july
    return q
