"""Steps that must not be repeated, nor pass the driver, as the tables grow."""
from pyspark.sql import functions as F

from blotter.operators import dims as D
from blotter.plans.pipeline import bronze_from_fixture
from blotter.operators.silver import silver as silver_op
from blotter.sources.fixture import incidents
from blotter.sources.tables import Layout, materialize, read_table
from blotter.streaming import flows, grain, late
from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_customers_are_not_broadcast(spark):
    plan = _plan(incidents(spark, SF001).select("dr_no", "location"))
    assert plan.count("BroadcastHashJoin") <= 1 and "SortMergeJoin" in plan


def test_keys_met_once(spark, scratch):
    """What rekey_late hands over is read from staged rows, not joined for each use."""
    layout = Layout(scratch)
    materialize(silver_op(bronze_from_fixture(spark, SF001)).limit(200), f"{scratch}/silver")
    silver = read_table(spark, f"{scratch}/silver")
    dims = D.build_dims(spark, silver)
    late.append_facts(silver, {**dims, "dim_status": dims["dim_status"].filter("false")}, layout, 1)
    plans, rows = [], []

    def seen(removed, added):
        plans.extend([_plan(removed), _plan(added)])
        rows.extend([removed.filter("status_key is null").count(), added.filter("status_key is not null").count()])

    got = late.rekey_late(spark, layout, {"dim_status": dims["dim_status"]}, on_change=seen)
    assert rows == [got["rows"], got["rows"]] and got["rows"] == silver.filter("status is not null").count() > 0
    assert not any("Join" in p for p in plans)


def test_row_hash_tells_rows_apart(spark):
    fields = ", ".join(f"{c} string" for c in late.NATURAL)
    none = [None] * (len(late.NATURAL) - 2)
    rows = [["1", "12", *none], ["11", "2", *none], ["", None, *none], [None, "", *none], ["-", None, *none], [None, "-", *none], ["1:1", None, *none]]
    assert spark.createDataFrame(rows, fields).select(late._row_hash().alias("h")).distinct().count() == len(rows)


def test_grain_judges_once(spark, scratch, monkeypatch):
    """Both tables are written from judged rows on disk."""
    plans, write = [], grain.write_part
    monkeypatch.setattr(grain, "write_part", lambda df, *a, **k: (plans.append(_plan(df)), write(df, *a, **k)))
    rows = spark.createDataFrame([(1, None), (1, None), (2, None)], "dr_no long, date_rptd timestamp")
    assert grain.enforce_grain(rows, Layout(scratch), 0) == {"unique": 2, "repeated": 1, "keys": 2}
    assert len(plans) == 3 and not any("Join" in p for p in plans)


def test_dimension_streams_read_their_columns(spark, scratch, monkeypatch):
    layout = Layout(scratch)
    materialize(silver_op(bronze_from_fixture(spark, SF001)).limit(50), layout.path(flows.SILVER))
    read = {}
    monkeypatch.setattr(D, "DATA_DIMS", {"dim_status": lambda s, cfg: (read.setdefault("columns", s.columns), D.dim_status(s, cfg))[1]})
    for _, q in flows.dimension_flows(spark, layout):
        q.awaitTermination()
    assert read["columns"] == ["status", "status_desc"]
    assert read_table(spark, layout.path("dim_status")).count() == read_table(spark, layout.path(flows.SILVER)).filter(F.col("status").isNotNull()).select("status").distinct().count()
