"""Property tests: the Spark expressions agree with a plain statement of the
rules for arbitrary ages, times and statuses."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blotter import config as C
from blotter.functions import expressions as X
from blotter.operators.silver import enrich


def py_age_group(age):
    clean = None if age is None or age < 0 or age > 120 else age
    if clean is None or clean == 0:
        return clean, "Unknown"
    for upper, label in C.SILVER_AGE_BANDS:
        if clean < upper:
            return clean, label
    return clean, C.SILVER_AGE_TOP


def py_raw_band(age):
    if age == 0:
        return "Unknown"
    if age is None:
        return "Invalid"
    for upper, label in C.RAW_AGE_BANDS:
        if age < upper:
            return label
    return "Invalid"


def py_time(t):
    if t is None:
        return None, None, "Evening"
    text = str(t).rjust(4, "0")[:4]
    try:
        hour = int(text[:2])
    except ValueError:
        hour = None
    try:
        minute = int(text[2:4])
    except ValueError:
        minute = None
    period = "Evening"
    for lo, hi, label in C.TIME_PERIODS:
        if hour is not None and lo <= hour < hi:
            period = label
    return hour, minute, period


ages = st.lists(st.one_of(st.none(), st.integers(-20, 200)), min_size=1, max_size=300)
times = st.lists(st.one_of(st.none(), st.integers(0, 99999)), min_size=1, max_size=300)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ages=ages, times=times)
def test_enrichment_matches_rules(spark, ages, times):
    n = max(len(ages), len(times))
    rows = [(i, ages[i % len(ages)], times[i % len(times)], dt.datetime(2021, 1, 2), dt.datetime(2021, 1, 1))
            for i in range(n)]
    df = spark.createDataFrame(rows, "id int, vict_age int, time_occ int, date_rptd timestamp_ntz, "
                                     "date_occ timestamp_ntz")
    df = df.selectExpr("*", "CAST(NULL AS DOUBLE) AS lat", "CAST(NULL AS DOUBLE) AS lon",
                       "CAST(NULL AS DOUBLE) AS weapon_used_cd", "CAST(NULL AS STRING) AS status")
    out = enrich(df).withColumn("raw_band", X.raw_age_band("vict_age")).collect()
    for r in out:
        assert (r.vict_age_clean, r.age_group) == py_age_group(r.vict_age)
        assert r.is_juvenile_victim == (r.vict_age_clean is not None and r.vict_age_clean < 18)
        assert r.raw_band == py_raw_band(r.vict_age)
        assert (r.hour, r.minute, r.time_period) == py_time(r.time_occ)
