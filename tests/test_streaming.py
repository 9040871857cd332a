"""Stream == batch: ingest the fixture as CSV files in two runs and compare
every layer with the batch pipeline over the same files."""

from collections import Counter

import pytest

from pyspark.sql import functions as F

from blotter.operators.fact import AUDIT_COLUMNS
from blotter.plans.pipeline import build_layers
from blotter.sources.csv import read_incidents_csv, with_ingest_audit
from blotter.sources.fixture import incidents
from blotter.sources.tables import Layout, read_table
from blotter.streaming import flows

from conftest import SF001


def _multiset(df, drop=()):
    cols = sorted(c for c in df.columns if c not in set(drop))
    return Counter(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("stateful", [False, True])
def test_stream_matches_batch(spark, scratch, stateful):
    src = f"{scratch}/input"
    parts = incidents(spark, SF001).withColumn("__part", F.pmod(F.coalesce("dr_no", F.lit(0)), F.lit(3)))
    for i in range(3):
        (parts.filter(F.col("__part") == i).drop("__part").coalesce(1)
         .write.option("header", True).csv(f"{src}_{i}"))
    import glob
    import os
    import shutil
    os.makedirs(src)
    for i in range(2):
        f = glob.glob(f"{src}_{i}/part-*.csv")[0]
        shutil.copy(f, f"{src}/part{i}.csv")

    layout = Layout(f"{scratch}/tables", checkpoints=f"{scratch}/checkpoints")
    r1 = flows.run_flows(spark, layout, src, stateful_dims=stateful)
    assert r1.rows[flows.BRONZE] > 0
    assert r1.quality["rows_in"] == r1.rows[flows.BRONZE]
    f = glob.glob(f"{src}_2/part-*.csv")[0]
    shutil.copy(f, f"{src}/part2.csv")
    r2 = flows.run_flows(spark, layout, src, stateful_dims=stateful)
    assert r2.rows[flows.BRONZE] > 0          # only the new file is read
    assert r1.rows[flows.BRONZE] + r2.rows[flows.BRONZE] == 1500

    # Batch over the same three files.
    batch_bronze = with_ingest_audit(read_incidents_csv(spark, src))
    L = build_layers(spark, batch_bronze)

    stream_fact = read_table(spark, layout.path(flows.FACT))
    assert stream_fact.count() == L.fact.count() == 1446
    assert _multiset(stream_fact, AUDIT_COLUMNS) == _multiset(L.fact, AUDIT_COLUMNS)
    for name in ["dim_status", "dim_location", "dim_premise", "dim_weapon", "dim_crime_type",
                 "dim_victim_demographics"]:
        assert _multiset(read_table(spark, layout.path(name)), ["created_date"]) == \
            _multiset(L.dims[name], ["created_date"]), name
    silver_cols = ["ingestion_datetime", "silver_processed_datetime", "source_filename"]
    assert _multiset(read_table(spark, layout.path(flows.SILVER)), silver_cols) == \
        _multiset(L.silver, silver_cols)
    assert read_table(spark, layout.path(flows.QUARANTINE)).count() == 1500 - 1446
    # Quality metrics of both runs add up to the rows dropped.
    dropped = r1.quality["rows_dropped"] + r2.quality["rows_dropped"]
    assert dropped == 1500 - 1446

    # A run with no new files reads nothing and changes no table (exactly once).
    r3 = flows.run_flows(spark, layout, src, stateful_dims=stateful)
    assert sum(r3.rows.values()) == 0
    assert read_table(spark, layout.path(flows.FACT)).count() == 1446
    assert read_table(spark, layout.path("dim_victim_demographics")).count() == \
        L.dims["dim_victim_demographics"].count()


def test_dimension_merge_is_idempotent_on_retry(spark, scratch):
    """A micro-batch replayed after a failure inserts no member twice."""
    from blotter.operators import dims as D
    from blotter.operators.silver import silver
    from blotter.plans.pipeline import bronze_from_fixture

    batch = silver(bronze_from_fixture(spark, SF001))
    path = f"{scratch}/dim_victim_demographics"
    merge = flows._merge_new_members("dim_victim_demographics", D.dim_victim, path, flows.C.DEFAULT)
    merge(batch, 0)
    first = read_table(spark, path).count()
    merge(batch, 0)                                    # replay of the same batch
    merge(batch.limit(100), 1)                         # a later batch with known members only
    assert read_table(spark, path).count() == first == D.dim_victim(batch).count()


def test_run_report_counts_every_micro_batch(spark, scratch):
    """Totals come from a listener, so they cover every micro-batch."""
    src = f"{scratch}/in"
    incidents(spark, SF001).repartition(6).write.option("header", True).csv(src)
    layout = Layout(f"{scratch}/tables", checkpoints=f"{scratch}/checkpoints")
    report = flows.RunReport()
    totals = flows._ProgressTotals()
    spark.streams.addListener(totals)
    try:
        q = flows.bronze_flow(spark, layout, src, max_files_per_trigger=1)
        flows._await(q, report, flows.BRONZE, totals)
        assert totals.done(str(q.id)).is_set()
        assert len(q.recentProgress) >= 6
    finally:
        spark.streams.removeListener(totals)
    assert report.rows[flows.BRONZE] == 1500
