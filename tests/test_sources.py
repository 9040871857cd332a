"""Sources and sinks: CSV scan with malformed-line capture, pinned schema,
ingest audit, spines, code tables, layout listing, layer counts."""

import os

from pyspark.sql import functions as F

from blotter.operators.marts import layer_counts
from blotter.plans.pipeline import bronze_from_fixture, run_batch
from blotter import config as C
from blotter.sources.csv import CORRUPT, read_incidents_csv, with_ingest_audit
from blotter.sources.schema import INCIDENT_SCHEMA, infer_and_pin_schema, load_pinned_schema
from blotter.sources.spines import code_table, date_spine, minute_spine
from blotter.sources.tables import Layout, read_table

from conftest import SF001

HEADER = ",".join(f.name for f in INCIDENT_SCHEMA.fields)
GOOD = "1,2021-01-02T00:00:00,2021-01-01T00:00:00,1200,1,AREA_1,101,1,110,X,,30,M,H,101.0,STREET,,,AA,Adult Arrest,110.0,,,,L,,34.0,-118.3"
BAD = "2,not-a-date,2021-01-01T00:00:00,xx,1,AREA_1"


def _write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_csv_scan_captures_malformed_lines(spark, scratch):
    _write(f"{scratch}/in/a.csv", [HEADER, GOOD, BAD])
    df = read_incidents_csv(spark, f"{scratch}/in", corrupt_col="_corrupt").cache()
    rows = {r.dr_no: r for r in df.collect()}
    assert rows[1]._corrupt is None and rows[1].time_occ == 1200
    assert rows[2]._corrupt == BAD and rows[2].date_rptd is None
    audited = with_ingest_audit(read_incidents_csv(spark, f"{scratch}/in"))
    assert audited.select("source_filename").first()[0].endswith("a.csv")


def test_infer_and_pin_schema_round_trip(spark, scratch):
    _write(f"{scratch}/in/a.csv", [HEADER, GOOD])
    schema = infer_and_pin_schema(spark, f"{scratch}/in", f"{scratch}/schema")
    assert schema["dr_no"].dataType.typeName() in ("integer", "long")
    assert load_pinned_schema(spark, f"{scratch}/schema") == schema


def test_integers_written_as_floats_and_truncated_lines_survive(spark, scratch):
    """5.0 reads as 5; a truncated line keeps its text and ends in quarantine."""
    names = [f.name for f in INCIDENT_SCHEMA.fields]
    values = {"dr_no": "1", "date_rptd": "2020-01-02T00:00:00", "date_occ": "2020-01-01T00:00:00", "time_occ": "1200.0",
              "area": "5.0", "rpt_dist_no": "501.0", "crm_cd": "110.0", "vict_age": "30.0", "lat": "34.0", "lon": "-118.2"}
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.csv", "w") as f:
        f.write(",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n2,2020-01-02T00:00:00\n")
    raw = with_ingest_audit(read_incidents_csv(spark, f"{scratch}/in", corrupt_col=CORRUPT))
    L = run_batch(spark, Layout(f"{scratch}/t"), raw)
    got = L.silver.select("time_occ", "area", "rpt_dist_no", "crm_cd", "vict_age").collect()
    assert [tuple(r) for r in got] == [(1200, 5, 501, 110, 30)]
    lost = read_table(spark, Layout(f"{scratch}/t").path(C.QUARANTINE)).collect()
    assert [r[CORRUPT] for r in lost] == ["2,2020-01-02T00:00:00"] and lost[0].failed_rules
    assert L.bronze.count() == L.silver.count() + len(lost)


def test_tables_and_comments_are_registered(spark, scratch):
    layout = Layout(f"{scratch}/tables", schema="blotter_test")
    spark.range(3).write.parquet(layout.path("dim_status"))
    spark.range(2).write.parquet(layout.path("any_other"))
    os.makedirs(f"{scratch}/tables/_checkpoints")
    layout.comment("any_other", "it's \\ free text")
    try:
        assert layout.register(spark) == layout.register(spark) == ["any_other", "dim_status"]
        assert spark.table("blotter_test.dim_status").count() == 3
        text = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED blotter_test.any_other").collect()}
        assert text["Comment"] == "it's \\ free text"
    finally:
        spark.sql("DROP SCHEMA IF EXISTS blotter_test CASCADE")


def test_spines_and_code_table(spark):
    assert date_spine(spark, "2019-01-01", "2029-12-31").count() == 4018
    assert minute_spine(spark).agg(F.min("minutes_since_midnight"), F.max("minutes_since_midnight")).first() == (0, 1439)
    assert sorted(code_table(spark, {"A": "a", "B": "b"}).collect()) == [("A", "a"), ("B", "b")]


def test_batch_pipeline_tables_and_layer_counts(spark, scratch):
    layout = Layout(f"{scratch}/tables")
    L = run_batch(spark, layout, bronze_from_fixture(spark, SF001))
    assert set(layout.tables(spark)) == {
        "incidents_bronze", "incidents_silver", "incidents_quarantine", "dim_date", "dim_time", "dim_status",
        "dim_location", "dim_premise", "dim_weapon", "dim_crime_type", "dim_victim_demographics",
        "fact_crime_incidents"}
    counts = {r.layer: r.rows for r in layer_counts(L.bronze, L.silver, L.fact).collect()}
    assert counts == {"Bronze": 1500, "Silver": 1446, "Fact": 1446}
    # Gate metrics were observed by the silver write itself.
    assert L.quality["rows_in"] == 1500 and L.quality["rows_dropped"] == 54
    assert L.quality["failed_valid_primary_key"] == 2 and L.quality["failed_valid_date_range"] == 3
