"""Properties of the star over the sf0.001 fixture and plan-shape checks."""

import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter import config as C
from blotter.operators import dims as D
from blotter.operators import profile as R
from blotter.operators import quality as Q
from blotter.operators.fact import STAR_ROLES, fact_incidents, fact_null_fk_counts, star_join
from blotter.plans.queries import registry
from blotter.plans.pipeline import bronze_from_fixture, run_batch
from blotter.sources.tables import Layout

from conftest import SF001


@pytest.fixture(scope="module")
def layers(spark):
    return run_batch(spark, Layout(tempfile.mkdtemp(prefix="blotter-test-", dir="/tmp")),
                     bronze_from_fixture(spark, SF001), C.Config(key_mode="md5"))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    return run_batch(spark, Layout(base), bronze_from_fixture(spark, SF001), C.Config())


def test_row_counts(layers):
    assert layers.bronze.count() == 1500
    assert layers.silver.count() == 1446
    assert layers.fact.count() == layers.silver.count()
    assert layers.dims["dim_date"].count() == 4018
    assert layers.dims["dim_time"].count() == 1440


def test_dims_unique_on_natural_key_and_keys_in_range(layers):
    for name, (key, natural) in D.NATURAL_KEYS.items():
        dim = layers.dims[name]
        assert Q.duplicate_keys(dim, natural).count() == 0, name
        bad = dim.filter((F.col(key) < -1) | (F.col(key) >= 1 << 60)).count()
        assert bad == 0, name


def test_foreign_keys_resolve(layers):
    for role in ["date_occurred", "date_reported", "time", "location", "crime_type", "victim",
                 "premise", "weapon", "status"]:
        dim_name, fk, dk, _ = STAR_ROLES[role]
        r = Q.orphan_keys(layers.fact, {fk: (layers.dims[dim_name], dk)}).first()
        assert r.orphan_rows == 0, fk


def test_reference_moduli_bound_keys(spark, layers):
    cfg = C.Config(key_modulus=True)
    for name, fn in D.DATA_DIMS.items():
        key = D.NATURAL_KEYS[name][0]
        mod = C.MOD_LARGE if name in ("dim_location", "dim_victim_demographics") else C.MOD_SMALL
        assert fn(layers.silver, cfg).filter((F.col(key) < -1) | (F.col(key) >= mod)).count() == 0, name


def test_null_foreign_keys_match_inputs(layers):
    s = layers.silver
    nulls = {r.foreign_key: r.null_rows for r in fact_null_fk_counts(layers.fact).collect()}
    assert nulls["date_reported_key"] == s.filter(F.col("date_rptd").isNull()).count()
    assert nulls["status_key"] == s.filter(F.col("status").isNull()).count()
    assert nulls["weapon_key"] == 0 and nulls["victim_demographic_key"] == 0


def test_retention_matches_gate(spark, layers):
    raw = layers.bronze
    r = R.retention(raw).first()
    assert r.rows_in == 1500 and r.rows_kept == layers.silver.count()
    assert r.pct_retained == round(100.0 * r.rows_kept / r.rows_in, 2)


def test_profile_all_equals_single_reports(spark, layers):
    raw = layers.bronze.drop("ingestion_datetime", "source_filename", "created_by")
    cfg = C.Config(as_of="2026-01-01")
    fused = R.profile_all(raw, cfg)
    single = {
        "null_profile": R.null_profile(raw), "key_stats": R.key_stats(raw),
        "district_stats": R.district_stats(raw), "location_stats": R.location_stats(raw),
        "top_profiles": R.top_profiles(raw), "sex_distribution": R.sex_distribution(raw),
        "invalid_areas": R.invalid_areas(raw), "lag_distribution": R.lag_distribution(raw),
        "cardinality_profile": R.cardinality_profile(raw), "issue_summary": R.issue_summary(raw, cfg),
    }
    for name, df in single.items():
        assert Counter(map(tuple, df.collect())) == Counter(map(tuple, fused[name].collect())), name
    assert set(fused) >= set(R.SCALAR_SPECS) | set(R.GROUPED_REPORTS) | {"cardinality_profile"}
    assert len(fused.cached) == 3
    fused.release()
    assert fused.cached == []


def test_approx_distinct_close_to_exact(layers):
    raw = layers.bronze.drop("ingestion_datetime", "source_filename", "created_by")
    exact = {r.column_name: r.distinct_count for r in R.cardinality_profile(raw).collect()}
    approx = {r.column_name: r.distinct_count for r in R.cardinality_profile(raw, approx=True).collect()}
    mixed = {r.column_name: r.distinct_count
             for r in R.cardinality_profile(raw, approx_columns=["dr_no", "mocodes"]).collect()}
    assert set(mixed) == set(exact)
    for c, n in exact.items():
        assert abs(approx[c] - n) <= max(2, 0.1 * n), c
        if c not in ("dr_no", "mocodes"):
            assert mixed[c] == n, c
        else:
            assert abs(mixed[c] - n) <= max(2, 0.1 * n), c


def _plan(df) -> str:
    """The executed physical plan (AQE's final plan when adaptive)."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def _jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_fact_plan_broadcasts_every_dimension_without_shuffling_the_fact(spark, tables):
    before = _jobs(spark)
    f = fact_incidents(tables.silver, tables.dims, C.Config(), sizes=tables.sizes)
    assert _jobs(spark) == before          # building the plan starts no job
    f.collect()
    plan = _plan(f)
    assert plan.count("BroadcastHashJoin") == 9, plan
    assert "SortMergeJoin" not in plan
    # The only exchanges are the broadcasts of the dimensions.
    assert "Exchange hashpartitioning" not in plan


def test_stored_fact_is_read_without_needless_joins(spark):
    """Registered marts read the written fact and join their own roles only."""
    reg = registry()
    for name, joins in (("arrest_rate", 0), ("density_grid", 0), ("top_areas", 1), ("type_by_period", 2)):
        df = reg[name](spark, SF001)
        df.collect()
        plan = _plan(df)
        assert plan.count("BroadcastHashJoin") + plan.count("SortMergeJoin") == joins, name
        assert "ExistingRDD" not in plan


def test_orphan_keys_scan_the_fact_once(spark, tables):
    df = Q.orphan_keys(tables.fact, {fk: (tables.dims[d], dk) for d, fk, dk, _ in STAR_ROLES.values()})
    assert {r.foreign_key: (r.null_rows, r.orphan_rows) for r in df.collect()}.keys() == {v[1] for v in STAR_ROLES.values()}
    assert _plan(df).count("date_occurred_key") and _plan(df).count(C.FACT) == 1
    less = tables.dims["dim_weapon"].filter("weapon_used_cd <> -1")
    one = Q.orphan_keys(tables.fact, {"weapon_key": (less, "weapon_key")}).first()
    assert one.orphan_keys == 1 and one.orphan_rows == tables.silver.filter("weapon_used_cd is null").count()


def test_star_join_falls_back_to_salted_shuffle_join_when_dimension_too_large(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        args = (tables.silver, tables.dims["dim_weapon"],
                [(F.coalesce(F.col("weapon_used_cd"), F.lit(-1.0)), "weapon_used_cd")],
                {"weapon_key": "weapon_key"}, "weapon")
        few = C.Config(broadcast_max_rows=10)
        salted = star_join(*args, cfg=few, known_rows=99, hot=[-1.0])
        plain = star_join(*args, cfg=few, known_rows=99)
        cast = star_join(*args, known_rows=99)
        for small in (C.Config(broadcast_max_bytes=1), C.Config()):
            unknown = star_join(*args, cfg=small, known_rows=99 if small.broadcast_max_bytes == 1 else None)
            assert "BroadcastHashJoin" not in _plan(unknown)
        rows = [Counter(map(tuple, j.select("dr_no", "weapon_key").collect())) for j in (salted, plain, cast)]
        assert rows[0] == rows[1] == rows[2]
        assert sum(rows[0].values()) == tables.silver.count()
        plan = _plan(salted)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "__weapon_salt" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_profile_scalar_pass_scans_once(spark, tables):
    raw = tables.bronze.drop("ingestion_datetime", "source_filename", "created_by")
    rep = R.profile_all(raw, C.Config(as_of="2026-01-01"), persist=False)["key_stats"]
    rep.collect()
    plan = _plan(rep)
    # One scan for the scalar aggregate, one for the stacked distinct pass.
    assert plan.count("FileScan parquet") <= 2, plan
    assert "Expand" not in plan.split("Subquery")[0]


def test_scan_prunes_columns_and_pushes_filters(spark, tables):
    q = tables.silver.filter(F.col("status") == "AA").select("dr_no", "status")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,AA)]" in plan
    assert "ReadSchema: struct<dr_no:bigint,status:string>" in plan


def test_fused_dimension_members_equal_separate_builds(spark, layers):
    sep = D.build_dims(spark, layers.silver)
    fused = D.build_dims(spark, layers.silver, fused=True)
    for name in D.DATA_DIMS:
        a = Counter(map(tuple, sep[name].drop("created_date").collect()))
        b = Counter(map(tuple, fused[name].drop("created_date").collect()))
        assert a == b, name


def test_marts_all_covers_every_mart(spark, tables):
    from blotter.operators import marts as M
    out = M.marts_all(lambda roles: tables.star(roles, C.DEFAULT))
    assert set(out) == set(M.MARTS)
    assert out["arrest_rate"].first().incidents == tables.fact.count()


def test_dimension_dedup_hash_aggregates_every_input_row(spark, tables):
    """The per-row aggregate of a dimension is a hash aggregate; the sort-based
    payload choice only sees the distinct (key, payload) pairs."""
    d = D.dim_victim(tables.silver)
    d.collect()
    plan = _plan(d)
    scan = plan.rfind("FileScan parquet")
    nearest = next(ln for ln in reversed(plan[:scan].splitlines()) if "Aggregate" in ln)
    assert "HashAggregate" in nearest and "SortAggregate" not in nearest, plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_period_change_scans_the_fact_once(spark, tables):
    from blotter.operators import marts as M
    y = M.yearly_yoy(tables.star(["date_occurred"]))
    y.collect()
    plan = _plan(y)
    fact_scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "fact_crime_incidents" in ln]
    assert len(fact_scans) == 1, plan
    assert "SortMergeJoin" not in plan
