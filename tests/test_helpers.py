"""Aggregate and audit helpers, layout scoping, partitioned fact layout."""

from pyspark.sql import functions as F

from blotter import config as C
from blotter.functions.audit import with_load_audit
from blotter.operators import aggregates as A
from blotter.operators import profile as R
from blotter.plans.pipeline import bronze_from_fixture, run_batch
from blotter.sources.fixture import incidents
from blotter.sources.tables import Layout, read_table

from conftest import SF001


def test_count_rules_numeric_stats_and_span(spark):
    df = incidents(spark, SF001)
    r = A.count_rules(df, {"zero_age": F.col("vict_age") == 0, "no_weapon": F.col("weapon_used_cd").isNull()}).first()
    assert r.total_rows == 1500 and r.zero_age == df.filter("vict_age = 0").count()
    s = A.numeric_stats(df, ["vict_age"], median=True).first()
    assert s.min_vict_age == -1 and s.max_vict_age == 130 and s.median_vict_age is not None
    span = df.agg(A.date_span("date_occ").alias("d")).first().d
    lo, hi = df.agg(F.min("date_occ"), F.max("date_occ")).first()
    assert span == (hi.date() - lo.date()).days


def test_approx_percentile_option(spark):
    df = incidents(spark, SF001)
    exact = R.lag_stats(df).first()
    approx = R.lag_stats(df, C.Config(approx_percentile=True)).first()
    assert abs(exact.median_days - approx.median_days) <= 1
    assert abs(exact.p90_days - approx.p90_days) <= 1


def test_load_audit_and_preview(spark):
    df = with_load_audit(spark.range(3), "flow_x", F.lit("2020-01-01").cast("timestamp"))
    r = df.first()
    assert r.created_by == "flow_x" and str(r.created_date).startswith("2020-01-01")
    assert A.preview(spark.range(100), 10).count() == 10


def test_layout_scoping(spark, scratch):
    lay = Layout(f"{scratch}/t", catalog=None, schema="default")
    lay.use(spark)
    assert spark.catalog.currentDatabase() == "default"
    assert lay.qualified("fact") == "default.fact"
    assert lay.checkpoint("bronze").endswith("/_checkpoints/bronze")


def test_partitioned_fact_prunes_by_date(spark, scratch):
    L = run_batch(spark, Layout(f"{scratch}/p"), bronze_from_fixture(spark, SF001),
                  fact_by_month=True)
    fact = read_table(spark, f"{scratch}/p/fact_crime_incidents")
    assert fact.count() == 1446
    # Clustered by month before the write: few files, not one per task and month.
    assert len(fact.inputFiles()) <= 2 * fact.select("month_occurred").distinct().count()
    q = fact.filter((F.col("month_occurred") == 202101) & (F.col("date_occurred_key") == 20210105))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_occurred" in plan
    assert q.count() == L.silver.filter(F.to_date("date_occ") == F.lit("2021-01-05").cast("date")).count()


def test_period_change_gaps_nulls_and_zero(spark):
    df = spark.createDataFrame([(2020, 10), (2021, 0), (2022, 5), (2024, 8), (None, 3)],
                               "year int, incidents bigint")
    rows = {r.year: r for r in A.period_change(df, F.col("year"), "incidents").collect()}
    assert len(rows) == 5
    assert rows[2020].prev_incidents is None and rows[2020].pct_change is None
    assert (rows[2021].prev_incidents, rows[2021].change, rows[2021].pct_change) == (10, -10, -100.0)
    assert (rows[2022].prev_incidents, rows[2022].pct_change) == (0, None)      # no % change from 0
    assert rows[2024].prev_incidents is None                                     # 2023 missing
    assert rows[None].prev_incidents is None and rows[None].incidents == 3
