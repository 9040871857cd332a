"""Profiles merged from the states of batches against those of the whole table."""

from collections import Counter

from pyspark.sql import functions as F

from blotter import config as C
from blotter.operators import profile as R
from blotter.operators import profile_state as P
from blotter.sources.fixture import incidents
from blotter.sources.tables import Layout, materialize, read_table

from conftest import SF001

CFG = C.Config(as_of="2026-01-01")


def rounded(df):
    """Rows with doubles to 9 places: sums of batches add in another order."""
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_merged_states_equal_the_whole_profile(spark, scratch):
    materialize(incidents(spark, SF001), f"{scratch}/rows")
    rows, layout = read_table(spark, f"{scratch}/rows"), Layout(f"{scratch}/t")
    part = F.coalesce(F.col("dr_no") % 5, F.lit(0))
    # Uneven batches, one of them empty, one written twice (the first time in part).
    P.write_states(rows.filter(part == 0), layout, 0, CFG)
    P.write_states(rows.filter(part == 1), layout, 1, CFG)
    P.write_states(rows.filter(part > 0), layout, 1, CFG)
    P.write_states(rows.filter("false"), layout, 2, CFG)
    got, want = P.merged_profile(spark, layout, rows.schema, CFG), R.profile_all(rows, CFG)
    assert set(got) == set(want)
    for name in sorted(set(want) - {"cardinality_profile"}):
        assert got[name].schema.simpleString() == want[name].schema.simpleString(), name
        assert rounded(got[name]) == rounded(want[name]), name
    exact = {r.column_name: r for r in want["cardinality_profile"].collect()}
    for r in got["cardinality_profile"].collect():
        e = exact.pop(r.column_name)
        assert r.total_records == e.total_records and abs(r.distinct_count - e.distinct_count) <= 0.04 * e.distinct_count + 0.5, r
    assert not exact
    want.release()


def test_states_of_no_rows(spark, scratch):
    rows, layout = incidents(spark, SF001).filter("false"), Layout(scratch)
    P.write_states(rows, layout, 0, CFG)
    got = P.merged_profile(spark, layout, rows.schema, CFG)
    assert got["lag_stats"].first().avg_days is None and got["hour_distribution"].isEmpty()
    assert got["location_stats"].first().unique_locations == 0


def test_a_report_reads_states_only(spark, scratch):
    materialize(incidents(spark, SF001), f"{scratch}/rows")
    rows, layout = read_table(spark, f"{scratch}/rows"), Layout(f"{scratch}/t")
    P.write_states(rows, layout, 0, CFG)
    got = P.merged_profile(spark, layout, rows.schema, CFG)
    for name in ("lag_stats", "key_stats", "top_profiles", "cardinality_profile"):
        assert all("/t/profile_" in f for f in got[name].inputFiles()), name
