"""Golden micro-rows: hand-worked expectations for the edge cases of the
enrichment, the quality gate, the dimensions and the fact."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blotter import config as C
from blotter.functions import expressions as X
from blotter.functions.keys import surrogate_key
from blotter.operators import dims as D
from blotter.operators import marts as M
from blotter.operators import profile as R
from blotter.operators import quality as Q
from blotter.operators.fact import fact_incidents
from blotter.operators.silver import silver
from blotter.sources.csv import with_ingest_audit
from blotter.sources.schema import INCIDENT_SCHEMA, SOURCE_COLUMNS

BASE = {
    "dr_no": 1, "date_rptd": dt.datetime(2021, 3, 2), "date_occ": dt.datetime(2021, 3, 1),
    "time_occ": 1200, "area": 1, "area_name": "AREA_1", "rpt_dist_no": 101, "part_1_2": 1,
    "crm_cd": 110, "crm_cd_desc": "BATTERY 110", "mocodes": None, "vict_age": 30, "vict_sex": "M",
    "vict_descent": "H", "premis_cd": 101.0, "premis_desc": "STREET", "weapon_used_cd": None,
    "weapon_desc": None, "status": "AA", "status_desc": "Adult Arrest", "crm_cd_1": 110.0,
    "crm_cd_2": None, "crm_cd_3": None, "crm_cd_4": None, "location": "X BL", "cross_street": None,
    "lat": 34.0, "lon": -118.3,
}


def frame(spark, *rows):
    data = []
    for i, r in enumerate(rows):
        d = dict(BASE)
        d["dr_no"] = 1000 + i
        d.update(r)
        data.append(tuple(d[c] for c in SOURCE_COLUMNS))
    return spark.createDataFrame(data, INCIDENT_SCHEMA)


def enriched(spark, *rows):
    return silver(with_ingest_audit(frame(spark, *rows), source="golden"))


@pytest.mark.parametrize("age, clean, group, juvenile, raw_band", [
    (-1, None, "Unknown", False, "0-17 (Juvenile)"),
    (0, 0, "Unknown", True, "Unknown"),
    (17, 17, "0-17 (Juvenile)", True, "0-17 (Juvenile)"),
    (18, 18, "18-24", False, "18-24"),
    (120, 120, "65+ (Senior)", False, "Invalid"),
    (121, None, "Unknown", False, "Invalid"),
    (None, None, "Unknown", False, "Invalid"),
])
def test_ages(spark, age, clean, group, juvenile, raw_band):
    r = enriched(spark, {"vict_age": age}).withColumn("raw", X.raw_age_band("vict_age")).first()
    assert (r.vict_age_clean, r.age_group, r.is_juvenile_victim, r.raw) == (clean, group, juvenile, raw_band)


@pytest.mark.parametrize("lat, lon, lat_c, lon_c", [
    (0.0, 0.0, None, None),
    (0.0, -118.3, 0.0, -118.3),
    (None, 0.0, None, 0.0),
])
def test_coordinates(spark, lat, lon, lat_c, lon_c):
    r = enriched(spark, {"lat": lat, "lon": lon}).first()
    assert (r.lat_clean, r.lon_clean) == (lat_c, lon_c)


@pytest.mark.parametrize("t, text, hour, minute, period", [
    (5, "0005", 0, 5, "Night"),
    (1800, "1800", 18, 0, "Evening"),
    (None, None, None, None, "Evening"),
    (12345, "1234", 12, 34, "Afternoon"),
    (2575, "2575", 25, 75, "Evening"),
])
def test_time_parts(spark, t, text, hour, minute, period):
    r = enriched(spark, {"time_occ": t}).first()
    assert (r.time_str, r.hour, r.minute, r.time_period) == (text, hour, minute, period)


@pytest.mark.parametrize("status, arrested", [("AA", True), ("JA", True), ("IC", False), (None, None)])
def test_arrest_flag(spark, status, arrested):
    assert enriched(spark, {"status": status}).first().is_arrested is arrested


def test_days_to_report_counts_calendar_days(spark):
    r = enriched(spark, {"date_occ": dt.datetime(2020, 1, 1, 23, 59),
                         "date_rptd": dt.datetime(2020, 1, 2, 0, 1)}).first()
    assert r.days_to_report == 1


def test_quality_gate(spark):
    rows = [{"date_occ": dt.datetime(2019, 12, 31), "date_rptd": dt.datetime(2020, 1, 2)},
            {"date_occ": None},
            {"dr_no": None},
            {"date_rptd": dt.datetime(2021, 2, 1)},       # reported before occurred
            {"date_rptd": None},                          # kept: NULL passes the date logic
            {}]
    df = frame(spark, *rows).withColumn("dr_no", F.when(F.col("dr_no") == 1002, None).otherwise(F.col("dr_no")))
    kept = Q.expect_all_or_drop(df, C.QUALITY_RULES)
    assert sorted(r.dr_no for r in kept.collect()) == [1004, 1005]
    q = {r.dr_no: r.failed_rules for r in Q.quarantine(df, C.QUALITY_RULES).collect()}
    assert q[1000] == "valid_date_range"
    assert q[1001] == "valid_date_range"                   # NULL occurrence fails
    assert q[None] == "valid_primary_key"
    assert q[1003] == "valid_date_logic"
    m = {r.rule: r.failed for r in Q.expectation_metrics(df, C.QUALITY_RULES).collect()}
    assert m == {"valid_primary_key": 1, "valid_date_logic": 1, "valid_date_range": 2}


@pytest.mark.parametrize("desc, category", [
    ("WAREHOUSE", "Residential"), ("CARD CLUB", "Vehicle"), ("PARKING LOT", "Street"),
    ("PARK", "Other"), (None, "Other"), ("STREET MARKET", "Street"), ("Department Store", "Commercial"),
])
def test_premise_categories(spark, desc, category):
    d = D.dim_premise(enriched(spark, {"premis_desc": desc}))
    assert d.first().premise_category == category


def test_victim_labels_and_null_member(spark):
    s = enriched(spark, {"vict_sex": "-", "vict_descent": "G"},
                 {"vict_age": None, "vict_sex": None, "vict_descent": None})
    d = {(r.vict_sex, r.vict_descent): r for r in D.dim_victim(s).collect()}
    assert (d[("-", "G")].sex_desc, d[("-", "G")].descent_desc) == ("Unknown", "Unknown")
    assert (None, None) in d
    dims = D.build_dims(spark, s)
    f = fact_incidents(s, dims)
    assert f.filter(F.col("victim_demographic_key").isNull()).count() == 0


def test_weapon_member_and_fact_key(spark):
    s = enriched(spark, {"weapon_used_cd": None}, {"weapon_used_cd": 200.0, "weapon_desc": "KNIFE"})
    w = {r.weapon_used_cd: r for r in D.dim_weapon(s).collect()}
    assert (w[-1.0].weapon_key, w[-1.0].weapon_desc) == (-1, "No Weapon")
    f = fact_incidents(s, D.build_dims(spark, s))
    assert sorted(r.weapon_key == -1 for r in f.collect()) == [False, True]


def test_region_and_null_district(spark):
    cfg = C.Config(key_mode="parity")
    s = enriched(spark, {"area": 5, "rpt_dist_no": None}, {"area": 13, "rpt_dist_no": 1301})
    loc = {r.area: r for r in D.dim_location(s, cfg).collect()}
    assert loc[5].geographic_region == "Other" and loc[13].geographic_region == "Central"
    assert loc[5].location_key == 42                      # hash(NULL) is the seed
    f = {r.dr_no: r.location_key for r in fact_incidents(s, D.build_dims(spark, s, cfg), cfg).collect()}
    assert f[1000] is None and f[1001] is not None        # NULL district never joins


def test_duplicate_business_keys_are_kept_and_reported(spark):
    df = frame(spark, {}, {}).withColumn("dr_no", F.lit(7).cast("bigint"))
    s = silver(with_ingest_audit(df, source="golden"))
    assert s.count() == 2
    assert [tuple(r) for r in Q.duplicate_keys(s, ["dr_no"]).collect()] == [(7, 2)]


def test_dim_date_rows(spark):
    d = {r.full_date: r for r in D.dim_date(spark).collect()}
    assert len(d) == 4018
    r = d[dt.date(2024, 10, 1)]
    assert (r.fiscal_year, r.fiscal_quarter, r.date_key) == (2025, 1, 20241001)
    r = d[dt.date(2021, 1, 1)]
    assert (r.week_of_year, r.week_of_month, r.is_weekday, r.day_of_week_name) == (53, 1, True, "Friday")
    july = {r.full_date: r for r in D.dim_date(spark, C.Config(fiscal_start_month=7)).collect()}
    assert (july[dt.date(2024, 7, 1)].fiscal_year, july[dt.date(2024, 7, 1)].fiscal_quarter) == (2025, 1)
    assert july[dt.date(2024, 1, 15)].fiscal_quarter == 3


def test_dim_time_rows(spark):
    d = {r.minutes_since_midnight: r for r in D.dim_time(spark).collect()}
    assert len(d) == 1440
    assert (d[720].time_key, d[720].time_12hr, d[720].time_period_detail) == (1200, "12:00 PM", "Noon (12-1PM)")
    assert (d[0].time_key, d[0].time_12hr, d[0].time_period_detail) == (0, "12:00 AM", "Midnight (12-1AM)")
    r = d[1020]
    assert (r.is_business_hours, r.hour_of_day_category, r.is_peak_hours) == (True, "Evening Peak", True)


def test_key_modes(spark):
    df = spark.createDataFrame([(102,), (None,)], "x int")
    r = df.select(
        surrogate_key(F.col("x"), 1_000_000, "parity").alias("p"),
        (F.abs(F.hash("x").cast("bigint")) % 1_000_000).alias("expected"),
        surrogate_key(F.col("x"), 1_000_000, "md5").alias("m"),
        surrogate_key(F.col("x"), 1_000_000, "xxhash64").alias("x64"),
    ).collect()
    assert r[0].p == r[0].expected and r[1].p == 42
    assert all(0 <= v.m < 1_000_000 and 0 <= v.x64 < 1_000_000 for v in r)
    assert r[1].m == 42 and r[1].x64 == 42


def test_known_text_wins_over_missing_text(spark):
    """A code seen without text in some rows takes the text it has elsewhere."""
    df = spark.createDataFrame([(1.0, None), (1.0, "STREET"), (1.0, "STREET"), (2.0, None)], "premis_cd double, premis_desc string")
    got = {r.premis_cd: r.premis_desc for r in D.dedup(df, ["premis_cd"], ["premis_desc"]).collect()}
    assert got == {1.0: "STREET", 2.0: None}


def test_areas_are_compared_as_numbers(spark):
    df = spark.createDataFrame([(5.0, "a"), (22.0, "b"), (None, "c"), (1.5, "d")], "area double, area_name string")
    assert sorted(r.area for r in R.invalid_areas(df).collect()) == [1.5, 22.0]


def test_grid_edges_fall_into_their_cell(spark):
    df = spark.createDataFrame([(34.15, -118.25), (34.149999, -118.3)], "latitude double, longitude double")
    assert sorted((r.lat_cell, r.lon_cell) for r in M.density_grid(df).collect()) == [(682, -2366), (683, -2365)]


def test_fixed_values_stated_independently():
    """The oracle shares the config, so a wrong value there would pass on both sides."""
    assert C.NO_WEAPON_CODE == -1.0
    assert list(C.VALID_AREAS) == list(range(1, 22))
    assert C.PROFILE_SEX_CODES == ["F", "M", "X", "H", "-"]
    assert C.RAW_AGE_BANDS[0] == (18, "0-17 (Juvenile)") and C.RAW_AGE_BANDS[-1] == (120, "65+ (Senior)")
    assert C.QUALITY_RULES["valid_date_range"] == "date_occ >= '2020-01-01'"
