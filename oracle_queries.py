"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is a ``WITH`` chain that rebuilds the incidents source, the
silver layer, the dimensions (md5 key mode) and the fact in plain SQL, then
the report itself. The fixed values (bands, labels, patterns) come from
``blotter.config`` so both sides state them once.
"""

from __future__ import annotations

from blotter import config as C
from blotter.operators.marts import MARTS
from blotter.operators.profile import ISSUES
from blotter.plans.queries import GRID_LEVELS, MERGED_REPORTS, QUANTILES
from blotter.sources.fixture import INCIDENTS_SQL
from blotter.sources.schema import SOURCE_COLUMNS

CFG_AS_OF = "2026-01-01"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _key(text: str, mod: int | None) -> str:
    bits = f"('0x' || substr(md5(CAST({text} AS VARCHAR)), 1, 15))::BIGINT"
    return f"coalesce({bits} % {mod}, 42)" if mod else f"coalesce({bits}, 42)"


def _bands(expr: str, bands, default: str, first=()) -> str:
    parts = [f"WHEN {cond} THEN {_q(label)}" for cond, label in first]
    parts += [f"WHEN {expr} < {upper} THEN {_q(label)}" for upper, label in bands]
    return "CASE " + " ".join(parts) + f" ELSE {_q(default)} END"


def _hour_band(expr: str, bands, default: str) -> str:
    parts = [f"WHEN {expr} >= {lo} AND {expr} < {hi} THEN {_q(label)}" for lo, hi, label in bands]
    return "CASE " + " ".join(parts) + f" ELSE {_q(default)} END"


def _labels(expr: str, mapping, default: str) -> str:
    parts = [f"WHEN {expr} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items()]
    return "CASE " + " ".join(parts) + f" ELSE {_q(default)} END"


def _regex(expr: str, patterns, default: str) -> str:
    parts = [f"WHEN regexp_matches({expr}, {_q('(?i)' + p)}) THEN {_q(label)}" for p, label in patterns]
    return "CASE " + " ".join(parts) + f" ELSE {_q(default)} END"


def _region(expr: str) -> str:
    parts = [f"WHEN {expr} IN ({', '.join(map(str, areas))}) THEN {_q(name)}" for name, areas in C.REGIONS]
    return "CASE " + " ".join(parts) + f" ELSE {_q(C.REGION_OTHER)} END"


def _in(values) -> str:
    return ", ".join(_q(v) for v in values)


RULES = {n: f"COALESCE(({t}), false)" for n, t in C.QUALITY_RULES.items()}
ALL_RULES = " AND ".join(RULES.values())
HHMM = "lpad(CAST(time_occ AS VARCHAR), 4, '0')"
HOUR = f"TRY_CAST(substr({HHMM}, 1, 2) AS INTEGER)"
MINUTE = f"TRY_CAST(substr({HHMM}, 3, 2) AS INTEGER)"
LAG = "CAST(date_diff('day', CAST(date_occ AS DATE), CAST(date_rptd AS DATE)) AS INTEGER)"
RAW_BAND = _bands("vict_age", C.RAW_AGE_BANDS, C.RAW_AGE_INVALID, first=[("vict_age = 0", C.AGE_UNKNOWN)])


def dim_date_sql(fiscal_start: int = 10) -> str:
    s = fiscal_start
    fy = "year(d)" if s == 1 else f"CASE WHEN month(d) >= {s} THEN year(d) + 1 ELSE year(d) END"
    return f"""SELECT
  CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS INTEGER) AS year, strftime(d, '%Y') AS year_name,
  CAST(quarter(d) AS INTEGER) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
  CAST(year(d) AS VARCHAR) || '-Q' || CAST(quarter(d) AS VARCHAR) AS year_quarter,
  CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_short,
  strftime(d, '%Y-%m') AS year_month, CAST(day(d) AS INTEGER) AS day,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_of_week_name,
  strftime(d, '%a') AS day_of_week_short, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  CAST(ceil(day(d) / 7) AS INTEGER) AS week_of_month,
  dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) IN (1, 2, 3, 4, 5) AS is_weekday,
  CAST({fy} AS INTEGER) AS fiscal_year,
  CAST(floor(((month(d) - {s} + 12) % 12) / 3) + 1 AS INTEGER) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(DATE '{C.DEFAULT.date_start}', DATE '{C.DEFAULT.date_end}', INTERVAL 1 DAY)) AS DATE) AS d)"""


DIM_TIME = f"""SELECT time_occ AS time_key, time_occ, hour, minute, minutes_since_midnight,
  lpad(CAST(hour AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute AS VARCHAR), 2, '0') AS time_24hr,
  CAST(hour_12 AS VARCHAR) || ':' || lpad(CAST(minute AS VARCHAR), 2, '0') || ' ' || am_pm AS time_12hr,
  hour_12, am_pm,
  {_hour_band('hour', C.TIME_PERIODS, C.TIME_PERIOD_OTHER)} AS time_period,
  {_hour_band('hour', C.TIME_PERIOD_DETAIL, C.TIME_PERIOD_DETAIL_OTHER)} AS time_period_detail,
  CASE WHEN hour IN (6, 7, 8) THEN 'Morning Peak' WHEN hour IN (17, 18, 19) THEN 'Evening Peak'
       WHEN hour >= 9 AND hour <= 16 THEN 'Business Hours' WHEN hour >= 20 OR hour <= 5 THEN 'Off Hours'
       ELSE 'Other' END AS hour_of_day_category,
  hour >= 9 AND hour <= 17 AS is_business_hours,
  hour IN (6, 7, 8, 17, 18, 19) AS is_peak_hours,
  'dim_time' AS created_by
FROM (SELECT *, CAST(hour * 100 + minute AS INTEGER) AS time_occ,
             CAST(CASE WHEN hour = 0 THEN 12 WHEN hour > 12 THEN hour - 12 ELSE hour END AS INTEGER) AS hour_12,
             CASE WHEN hour < 12 THEN 'AM' ELSE 'PM' END AS am_pm
      FROM (SELECT CAST(m AS INTEGER) AS minutes_since_midnight, CAST(m // 60 AS INTEGER) AS hour,
                   CAST(m % 60 AS INTEGER) AS minute FROM range(1440) t(m)))"""

SILVER0 = f"""SELECT * REPLACE ({_q(C.FLOW_SILVER)} AS created_by),
  CASE WHEN vict_age < 0 THEN NULL WHEN vict_age > {C.DEFAULT.max_age} THEN NULL ELSE vict_age END AS vict_age_clean,
  CASE WHEN lat = 0 AND lon = 0 THEN NULL ELSE lat END AS lat_clean,
  CASE WHEN lat = 0 AND lon = 0 THEN NULL ELSE lon END AS lon_clean,
  {HHMM} AS time_str, {HOUR} AS hour, {MINUTE} AS minute,
  {LAG} AS days_to_report
FROM bronze WHERE {ALL_RULES}"""

AGE_GROUP = _bands("vict_age_clean", C.SILVER_AGE_BANDS, C.SILVER_AGE_TOP,
                   first=[("vict_age_clean IS NULL", C.AGE_UNKNOWN), ("vict_age_clean = 0", C.AGE_UNKNOWN)])
FLAGS = f"""weapon_used_cd IS NOT NULL AS is_weapon_involved,
  CASE WHEN vict_age_clean < 18 THEN true ELSE false END AS is_juvenile_victim,
  status IN ({_in(C.ARREST_STATUSES)}) AS is_arrested"""

SILVER = f"""SELECT *, {AGE_GROUP} AS age_group,
  {_hour_band('hour', C.TIME_PERIODS, C.TIME_PERIOD_OTHER)} AS time_period,
  {FLAGS}
FROM silver0"""

DIM_STATUS = f"""SELECT {_key('status', None)} AS status_key, status, min(status_desc) AS status_desc,
  'dim_status_flow' AS created_by
FROM silver WHERE status IS NOT NULL GROUP BY status"""

DIM_LOCATION = f"""SELECT {_key("CAST(area AS VARCHAR) || '_' || CAST(rpt_dist_no AS VARCHAR)", None)} AS location_key,
  area, min(area_name) AS area_name, rpt_dist_no, {_region('area')} AS geographic_region,
  'dim_location_flow' AS created_by
FROM silver WHERE area IS NOT NULL GROUP BY area, rpt_dist_no"""

DIM_PREMISE = f"""SELECT {_key('premis_cd', None)} AS premise_key, premis_cd, premis_desc,
  {_regex('premis_desc', C.PREMISE_CATEGORIES, C.PREMISE_OTHER)} AS premise_category,
  'dim_premise_flow' AS created_by
FROM (SELECT premis_cd, min(premis_desc) AS premis_desc FROM silver WHERE premis_cd IS NOT NULL GROUP BY premis_cd)"""

DIM_WEAPON = f"""SELECT CASE WHEN weapon_used_cd IS NULL THEN {C.NO_WEAPON_KEY} ELSE {_key('weapon_used_cd', None)} END AS weapon_key,
  coalesce(weapon_used_cd, {C.NO_WEAPON_CODE}) AS weapon_used_cd,
  CASE WHEN weapon_used_cd IS NULL THEN {_q(C.NO_WEAPON_DESC)} ELSE weapon_desc END AS weapon_desc,
  'dim_weapon_flow' AS created_by
FROM (SELECT weapon_used_cd, min(weapon_desc) AS weapon_desc FROM silver GROUP BY weapon_used_cd)"""


def dim_crime_sql(categories: bool = False) -> str:
    extra = ""
    if categories:
        cat = _regex("crm_cd_desc", C.CRIME_CATEGORIES, C.CRIME_OTHER)
        extra = f"{cat} AS crime_category, ({cat}) = 'Violent' AS is_violent, "
    return f"""SELECT {_key('crm_cd', None)} AS crime_type_key, crm_cd, crm_cd_desc, part_1_2,
  {extra}'dim_crime_type_flow' AS created_by
FROM (SELECT crm_cd, p.crm_cd_desc AS crm_cd_desc, p.part_1_2 AS part_1_2 FROM (
  SELECT crm_cd, min(struct_pack(crm_cd_desc := crm_cd_desc, part_1_2 := part_1_2)) AS p
  FROM silver WHERE crm_cd IS NOT NULL GROUP BY crm_cd))"""


VICTIM_TEXT = ("coalesce(CAST(vict_age_clean AS VARCHAR), 'null') || '_' || coalesce(vict_sex, 'null')"
               " || '_' || coalesce(vict_descent, 'null')")
DIM_VICTIM = f"""SELECT {_key(VICTIM_TEXT, None)} AS victim_demographic_key,
  vict_age_clean, age_group, vict_sex, {_labels('vict_sex', C.SEX_LABELS, C.LABEL_UNKNOWN)} AS sex_desc,
  vict_descent, {_labels('vict_descent', C.DESCENT_LABELS, C.LABEL_UNKNOWN)} AS descent_desc,
  'dim_victim_demographics_flow' AS created_by
FROM (SELECT vict_age_clean, vict_sex, vict_descent, min(age_group) AS age_group FROM silver
      GROUP BY vict_age_clean, vict_sex, vict_descent)"""

FACT = f"""SELECT {_key('s.dr_no', None)} AS incident_key, s.dr_no,
  d1.date_key AS date_occurred_key, d2.date_key AS date_reported_key, t.time_key AS time_occurred_key,
  l.location_key, c.crime_type_key, v.victim_demographic_key, p.premise_key, w.weapon_key, st.status_key,
  s.location AS location_address, s.cross_street, s.lat_clean AS latitude, s.lon_clean AS longitude,
  s.mocodes, s.days_to_report, 1 AS crime_count,
  s.is_weapon_involved, s.is_juvenile_victim, s.is_arrested, {_q(C.FLOW_FACT)} AS created_by
FROM silver s
LEFT JOIN dim_date d1 ON CAST(s.date_occ AS DATE) = d1.full_date
LEFT JOIN dim_date d2 ON CAST(s.date_rptd AS DATE) = d2.full_date
LEFT JOIN dim_time t ON s.time_occ = t.time_occ
LEFT JOIN dim_location l ON s.area = l.area AND s.rpt_dist_no = l.rpt_dist_no
LEFT JOIN dim_crime_type c ON s.crm_cd = c.crm_cd
LEFT JOIN dim_victim v ON s.vict_age_clean IS NOT DISTINCT FROM v.vict_age_clean
  AND s.vict_sex IS NOT DISTINCT FROM v.vict_sex AND s.vict_descent IS NOT DISTINCT FROM v.vict_descent
LEFT JOIN dim_premise p ON s.premis_cd = p.premis_cd
LEFT JOIN dim_weapon w ON coalesce(s.weapon_used_cd, {C.NO_WEAPON_CODE}) = w.weapon_used_cd
LEFT JOIN dim_status st ON s.status = st.status"""

CTES = {
    "incidents": INCIDENTS_SQL,
    "bronze": f"SELECT *, 'incidents' AS source_filename, {_q(C.FLOW_BRONZE)} AS created_by FROM incidents",
    "silver0": SILVER0,
    "silver": SILVER,
    "dim_date": dim_date_sql(10),
    "dim_time": DIM_TIME,
    "dim_status": DIM_STATUS,
    "dim_location": DIM_LOCATION,
    "dim_premise": DIM_PREMISE,
    "dim_weapon": DIM_WEAPON,
    "dim_crime_type": dim_crime_sql(False),
    "dim_victim": DIM_VICTIM,
    "fact": FACT,
}


def W(body: str, **override: str) -> str:
    ctes = dict(CTES)
    ctes.update(override)
    return "WITH " + ",\n".join(f"{k} AS (\n{v}\n)" for k, v in ctes.items()) + "\n" + body


# ---------------------------------------------------------------- star roles
ROLE_JOIN = {
    "date_occurred": "LEFT JOIN (SELECT date_key, full_date, year, quarter, year_quarter, month, month_name, "
                     "year_month, day, day_of_week, day_of_week_name, week_of_year, is_weekend, fiscal_year, "
                     "fiscal_quarter FROM dim_date) dd ON f.date_occurred_key = dd.date_key",
    "time": "LEFT JOIN (SELECT time_key, hour, minute, time_period FROM dim_time) dt ON f.time_occurred_key = dt.time_key",
    "location": "LEFT JOIN (SELECT location_key AS lk, area, area_name, rpt_dist_no, geographic_region FROM dim_location) dl "
                "ON f.location_key = dl.lk",
    "crime_type": "LEFT JOIN (SELECT crime_type_key AS ck, crm_cd, crm_cd_desc, part_1_2 FROM dim_crime_type) dc "
                  "ON f.crime_type_key = dc.ck",
    "victim": "LEFT JOIN (SELECT victim_demographic_key AS vk, age_group, sex_desc, descent_desc FROM dim_victim) dv "
              "ON f.victim_demographic_key = dv.vk",
    "weapon": "LEFT JOIN (SELECT weapon_key AS wk, weapon_used_cd, weapon_desc FROM dim_weapon) dw ON f.weapon_key = dw.wk",
    "status": "LEFT JOIN (SELECT status_key AS sk, status, status_desc FROM dim_status) ds ON f.status_key = ds.sk",
}


def star(*roles: str) -> str:
    return "(SELECT * FROM fact f " + " ".join(ROLE_JOIN[r] for r in roles) + ")"


def period_change(inner: str, keys: str, idx: str) -> str:
    return f"""SELECT c.* EXCLUDE (__idx), p.incidents AS prev_incidents, c.incidents - p.incidents AS change,
  round(CAST(c.incidents - p.incidents AS DOUBLE) * 100.0 / CASE WHEN p.incidents <> 0 THEN CAST(p.incidents AS DOUBLE) END, 2) AS pct_change
FROM (SELECT {keys}, incidents, {idx} AS __idx FROM ({inner})) c
LEFT JOIN (SELECT {idx} + 1 AS __idx, incidents FROM ({inner})) p ON c.__idx = p.__idx"""


def pct(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) * 100.0 / CASE WHEN {den} <> 0 THEN CAST({den} AS DOUBLE) END, 2)"


WEAPON_CAT = (f"CASE WHEN weapon_key <> {C.NO_WEAPON_KEY} AND weapon_key IS NOT NULL THEN "
              + _regex("weapon_desc", C.WEAPON_CATEGORIES, C.WEAPON_OTHER) + f" ELSE {_q(C.WEAPON_NONE)} END")


def _unpivot_counts(select_list: str, cols: list[str], name: str, value: str, src: str = "incidents") -> str:
    on = ", ".join(f'"{c}"' for c in cols)
    return f"(UNPIVOT (SELECT count(*) AS __n, {select_list} FROM {src}) ON {on} INTO NAME {name} VALUE {value})"


def null_profile(src: str, cols: list[str]) -> str:
    sel = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in cols)
    raw = "CAST(null_count AS DOUBLE) * 100.0 / __n"
    return f"""SELECT column_name, null_count, round({raw}, 2) AS null_pct, __n - null_count AS non_null_count,
  round(100.0 - {raw}, 2) AS completeness_pct FROM {_unpivot_counts(sel, cols, 'column_name', 'null_count', src)}"""


def _class(expr: str, classes, last: str, op: str) -> str:
    parts = [f"WHEN {expr} {op} {lo} THEN {_q(label)}" for lo, label in classes]
    return "CASE " + " ".join(parts) + f" ELSE {_q(last)} END"


def cardinality(src: str, cols: list[str]) -> str:
    sel = ", ".join(f'count(DISTINCT "{c}") + max(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS "{c}"' for c in cols)
    raw = "CAST(distinct_count AS DOUBLE) * 100.0 / __n"
    return f"""SELECT column_name, distinct_count, __n AS total_records, round({raw}, 2) AS cardinality_ratio_pct,
  {_class(raw, C.CARDINALITY_CLASSES, C.CARDINALITY_CLASS_LAST, '>')} AS category
FROM {_unpivot_counts(sel, cols, 'column_name', 'distinct_count', src)}"""


# DuckDB type name -> Spark simple type name, for the columns of the views.
SPARK_TYPE_NAMES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
                    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean"}


def schema_profile_sql(src: str, cols: list[str]) -> str:
    """Column order, Spark type name (from DuckDB's own typeof), nullable
    (every column of a Parquet-derived view is) and non-null count."""
    counts = ", ".join(f'count("{c}") AS "{c}"' for c in cols)
    types = ", ".join(f'typeof("{c}") AS "{c}"' for c in cols)
    on = ", ".join(f'"{c}"' for c in cols)
    order = ", ".join(f"({i + 1}, {_q(c)})" for i, c in enumerate(cols))
    mapping = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in SPARK_TYPE_NAMES.items())
    return f"""SELECT o.ordinal, o.column_name, CASE t.duck_type {mapping} END AS data_type, true AS nullable,
  n.non_null_count
FROM (VALUES {order}) o(ordinal, column_name)
JOIN (UNPIVOT (SELECT {counts} FROM {src}) ON {on} INTO NAME column_name VALUE non_null_count) n
  ON o.column_name = n.column_name
JOIN (UNPIVOT (SELECT {types} FROM {src} LIMIT 1) ON {on} INTO NAME column_name VALUE duck_type) t
  ON o.column_name = t.column_name"""


def completeness_sql(src: str, cols: list[str]) -> str:
    nulls = " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in cols)
    n = len(cols)
    raw = f"CAST(total_rows * {n} - null_cells AS DOUBLE) * 100.0 / (total_rows * {n})"
    return f"""SELECT total_rows, {n} AS total_columns, total_rows * {n} AS total_cells, null_cells,
  total_rows * {n} - null_cells AS non_null_cells, round({raw}, 2) AS completeness_pct,
  {_class(raw, C.COMPLETENESS_GRADES, C.COMPLETENESS_GRADE_LAST, '>=')} AS grade
FROM (SELECT count(*) AS total_rows, {nulls} AS null_cells FROM {src})"""


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
EVENTS_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _sample(pred: str, cols: list[str], k: int = 10) -> str:
    c = ", ".join(cols)
    o = ", ".join(f"{x} ASC NULLS LAST" for x in cols)
    return W(f"SELECT {c} FROM incidents WHERE {pred} ORDER BY {o} LIMIT {k}")


def _count_pct(name: str, pred: str) -> str:
    return W(f"""SELECT {name}, total_rows, {pct(name, 'total_rows')} AS pct FROM (
  SELECT count(*) FILTER (WHERE {pred}) AS {name}, count(*) AS total_rows FROM incidents)""")


LAT_BAD = f"(lat < {C.DEFAULT.lat_bounds[0]} OR lat > {C.DEFAULT.lat_bounds[1]})"
LON_BAD = f"(lon < {C.DEFAULT.lon_bounds[0]} OR lon > {C.DEFAULT.lon_bounds[1]})"
AS_OF = f"TIMESTAMP '{CFG_AS_OF}'"


def _bronze_step(cols: str) -> str:
    return W(f"""SELECT dr_no, {cols} FROM (
  SELECT *, {AGE_GROUP} AS age_group, {_hour_band('hour', C.TIME_PERIODS, C.TIME_PERIOD_OTHER)} AS time_period, {FLAGS}
  FROM (SELECT *,
    CASE WHEN vict_age < 0 THEN NULL WHEN vict_age > {C.DEFAULT.max_age} THEN NULL ELSE vict_age END AS vict_age_clean,
    CASE WHEN lat = 0 AND lon = 0 THEN NULL ELSE lat END AS lat_clean,
    CASE WHEN lat = 0 AND lon = 0 THEN NULL ELSE lon END AS lon_clean,
    {HHMM} AS time_str, {HOUR} AS hour, {MINUTE} AS minute, {LAG} AS days_to_report
  FROM incidents))""")


def _usage(dim: str) -> str:
    return W(f"""SELECT d.*, coalesce(o.n, 0) AS incidents_occurred, coalesce(r.n, 0) AS incidents_reported
FROM {dim} d
LEFT JOIN (SELECT CAST(date_occ AS DATE) AS full_date, count(*) AS n FROM silver GROUP BY 1) o ON d.full_date = o.full_date
LEFT JOIN (SELECT CAST(date_rptd AS DATE) AS full_date, count(*) AS n FROM silver GROUP BY 1) r ON d.full_date = r.full_date""",
             dim_date_july=dim_date_sql(7))


FK_ROLES = [
    ("date_occurred_key", "dim_date", "date_key"),
    ("date_reported_key", "dim_date", "date_key"),
    ("time_occurred_key", "dim_time", "time_key"),
    ("location_key", "dim_location", "location_key"),
    ("crime_type_key", "dim_crime_type", "crime_type_key"),
    ("victim_demographic_key", "dim_victim", "victim_demographic_key"),
    ("premise_key", "dim_premise", "premise_key"),
    ("weapon_key", "dim_weapon", "weapon_key"),
    ("status_key", "dim_status", "status_key"),
]

NATURAL = [
    ("dim_status", "status_key", "status"),
    ("dim_location", "location_key", "area, rpt_dist_no"),
    ("dim_premise", "premise_key", "premis_cd"),
    ("dim_weapon", "weapon_key", "weapon_used_cd"),
    ("dim_crime_type", "crime_type_key", "crm_cd"),
    ("dim_victim_demographics", "victim_demographic_key", "vict_age_clean, vict_sex, vict_descent"),
]


def oracle_registry() -> dict[str, str]:
    src = ", ".join(SOURCE_COLUMNS)
    q: dict[str, str] = {}
    # E1-E10
    q["clean_age"] = _bronze_step("vict_age_clean")
    q["clean_coords"] = _bronze_step("lat_clean, lon_clean")
    q["age_group"] = _bronze_step("vict_age_clean, age_group")
    q["time_parts"] = _bronze_step("time_str, hour, minute")
    q["time_period"] = _bronze_step("time_str, hour, minute, time_period")
    q["days_to_report"] = _bronze_step("days_to_report")
    q["incident_flags"] = _bronze_step("vict_age_clean, is_weapon_involved, is_juvenile_victim, is_arrested")
    q["silver"] = W("SELECT * FROM silver")
    q["stream_silver"] = q["silver"]
    # Q1-Q7
    q["expect_drop"] = W(f"SELECT {src} FROM incidents WHERE {ALL_RULES}")
    q["expectation_metrics"] = W(f"""SELECT rule, __n AS rows_checked, __n - failed AS passed, failed,
  {pct('failed', '__n')} AS pct_failed
FROM (UNPIVOT (SELECT count(*) AS __n, {', '.join(f'count(*) FILTER (WHERE NOT {r}) AS {n}' for n, r in RULES.items())}
  FROM incidents) ON {', '.join(RULES)} INTO NAME rule VALUE failed)""")
    failed = ", ".join(f"CASE WHEN NOT {r} THEN {_q(n)} END" for n, r in RULES.items())
    q["quarantine"] = W(f"SELECT {src}, concat_ws(',', {failed}) AS failed_rules FROM incidents WHERE NOT ({ALL_RULES})")
    q["unexpected_values"] = W(f"""SELECT vict_descent, count(*) AS "rows" FROM incidents
WHERE vict_descent IS NOT NULL AND vict_descent NOT IN ({_in(C.PROFILE_DESCENT_CODES)}) GROUP BY vict_descent""")
    q["orphan_keys"] = W(" UNION ALL ".join(f"""SELECT {_q(fk)} AS foreign_key,
  count(*) FILTER (WHERE f.{fk} IS NULL) AS null_rows,
  count(*) FILTER (WHERE f.{fk} IS NOT NULL AND d.k IS NULL) AS orphan_rows,
  count(DISTINCT f.{fk}) FILTER (WHERE f.{fk} IS NOT NULL AND d.k IS NULL) AS orphan_keys
FROM fact f LEFT JOIN (SELECT DISTINCT {dk} AS k FROM {dim}) d ON f.{fk} = d.k""" for fk, dim, dk in FK_ROLES))
    q["duplicate_keys"] = W('SELECT dr_no, count(*) AS "rows" FROM incidents GROUP BY dr_no HAVING count(*) > 1')
    q["duplicate_districts"] = W('SELECT area, rpt_dist_no, count(*) AS "rows" FROM incidents '
                                 "GROUP BY area, rpt_dist_no HAVING count(*) > 1")
    q["incident_key_collisions"] = W(f"""SELECT "key", count(*) AS natural_keys FROM (
  SELECT DISTINCT {_key('dr_no', 9973)} AS "key", dr_no FROM incidents) GROUP BY "key" HAVING count(*) > 1""")
    q["key_collisions"] = W(" UNION ALL ".join(f"""SELECT {_q(name)} AS dimension, CAST(coalesce(sum(m), 0) AS BIGINT) AS members,
  count(*) AS distinct_keys, count(*) FILTER (WHERE m > 1) AS colliding_keys
FROM (SELECT {key}, count(*) AS m FROM (SELECT DISTINCT {key}, {nat} FROM {name.replace('_demographics', '')}) GROUP BY {key})"""
                                               for name, key, nat in NATURAL))
    # D1-D8, G3
    q["dim_date"] = _usage("dim_date")
    q["fiscal_july"] = _usage("dim_date_july")
    q["dim_time"] = W("""SELECT d.*, coalesce(n.incidents, 0) AS incidents FROM dim_time d
LEFT JOIN (SELECT time_occ, count(*) AS incidents FROM silver GROUP BY time_occ) n ON d.time_occ = n.time_occ""")
    for name in ["dim_status", "dim_location", "dim_premise", "dim_weapon", "dim_crime_type", "dim_victim"]:
        q[name] = W(f"SELECT * FROM {name}")
    q["crime_category"] = W("SELECT * FROM dim_crime_type", dim_crime_type=dim_crime_sql(True))
    q["out_of_bounds_flag"] = W(f"""SELECT dr_no, lat, lon, lat_clean, lon_clean,
  coalesce({LAT_BAD} OR {LON_BAD}, false) AS is_out_of_bounds FROM silver""")
    q["fact_incidents"] = q["flows_fact"] = W("SELECT * FROM fact")
    q["flows_dim_location"] = q["dim_location"]
    # Across runs, and exact forms with bounded memory.
    q["late_members_fact"] = q["fact_incidents"]
    q["settled_locations"] = W("SELECT * FROM dim_location", silver="SELECT * REPLACE (CASE dr_no % 3 WHEN 0 THEN area_name "
                               f"WHEN 1 THEN lower(area_name) END AS area_name) FROM ({SILVER})")
    fresh = "FROM incidents WHERE dr_no % 10 = 1 AND date_rptd IS NOT NULL"
    q["unique_incidents"] = W(f"""SELECT dr_no, status, 'kept' AS outcome FROM incidents
UNION ALL SELECT dr_no, 'again', 'unique_incident' FROM incidents WHERE dr_no % 10 = 0
UNION ALL SELECT -dr_no, 'fresh', 'kept' {fresh} UNION ALL SELECT -dr_no, 'later', 'unique_incident' {fresh}""")
    part = "coalesce(dr_no % 4, 0)"
    q["drifted_incidents"] = W(f"""SELECT * REPLACE (
  CASE WHEN {part} <> 1 THEN mocodes END AS mocodes, CASE WHEN {part} <> 1 THEN cross_street END AS cross_street,
  CASE WHEN {part} = 2 AND area = 3 THEN NULL ELSE vict_age END AS vict_age, CASE WHEN {part} = 3 AND lat = 0 THEN NULL ELSE lat END AS lat),
  CASE WHEN {part} = 1 THEN 'Beat No=B' || area WHEN {part} = 2 AND area = 3 THEN 'vict_age=30+'
    WHEN {part} = 3 AND lat = 0 THEN 'lat=n/a' END AS rescued_cells, CAST(NULL AS VARCHAR) AS corrupt_record FROM incidents""")
    q["drift_report"] = W(f"""SELECT * FROM (
  SELECT 'Beat No' AS column_name, count(*) AS cells, false AS known, 'string' AS fits FROM incidents WHERE {part} = 1
  UNION ALL SELECT 'vict_age', count(*), true, 'string' FROM incidents WHERE {part} = 2 AND area = 3
  UNION ALL SELECT 'lat', count(*), true, 'string' FROM incidents WHERE {part} = 3 AND lat = 0) WHERE cells > 0""")
    q["exact_quantiles"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob, round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM lineitem"
        for c in ("l_extendedprice", "l_quantity") for p in QUANTILES)
    q["proven_top"] = """SELECT 'l_partkey' AS column_name, * FROM (SELECT l_partkey AS "key", count(*) AS "count" FROM lineitem
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25)
UNION ALL SELECT 'root', * FROM (SELECT CAST(floor(sqrt(sqrt(l_partkey))) AS BIGINT) AS "key", count(*) AS "count" FROM lineitem
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)"""
    q["dense_location_keys"] = W("""SELECT area, rpt_dist_no, row_number() OVER (ORDER BY later, area NULLS FIRST, rpt_dist_no NULLS FIRST) - 1 AS "key"
FROM (SELECT area, rpt_dist_no, CAST(min(CASE WHEN dr_no % 3 = 0 THEN 0 ELSE 1 END) AS INT) AS later FROM silver WHERE area IS NOT NULL
  GROUP BY area, rpt_dist_no)""")
    finest = 12
    place = {c: f"CAST(round(({c} + {span // 2}) * 1000000) AS BIGINT) * {1 << finest} // {span * 1000000}"
             for c, span in (("latitude", 180), ("longitude", 360))}
    bits = " + ".join(f"(((y >> {b}) & 1) << {2 * b + 1}) + (((x >> {b}) & 1) << {2 * b})" for b in range(finest))
    q["grid_levels"] = W(" UNION ALL ".join(f"""SELECT {n} AS level, z >> {2 * (finest - n)} AS cell, count(*) AS incidents
FROM (SELECT {bits} AS z FROM (SELECT {place['latitude']} AS y, {place['longitude']} AS x FROM fact
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL)) GROUP BY 1, 2""" for n in GRID_LEVELS))
    q["flows_layer_rows"] = W("""SELECT 'bronze' AS layer, count(*) AS "rows" FROM incidents
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'fact', count(*) FROM fact
UNION ALL SELECT 'quarantine', (SELECT count(*) FROM incidents) - (SELECT count(*) FROM silver)""")
    q["fact_null_fk_counts"] = W(f"""SELECT foreign_key, null_rows, __n AS fact_rows FROM (UNPIVOT (
  SELECT count(*) AS __n, {', '.join(f'count(*) FILTER (WHERE {fk} IS NULL) AS {fk}' for fk, _, _ in FK_ROLES)} FROM fact)
  ON {', '.join(fk for fk, _, _ in FK_ROLES)} INTO NAME foreign_key VALUE null_rows)""")
    # R2-R28
    q["schema_profile"] = W(schema_profile_sql("incidents", SOURCE_COLUMNS))
    q["null_profile"] = W(null_profile("incidents", SOURCE_COLUMNS))
    q["null_profile_orders"] = null_profile("orders", ORDERS_COLS)
    q["completeness"] = W(completeness_sql("incidents", SOURCE_COLUMNS))
    q["completeness_orders"] = completeness_sql("orders", ORDERS_COLS)
    q["null_profile_events"] = null_profile("events", EVENTS_COLS)
    q["cardinality_profile"] = W(cardinality("incidents", SOURCE_COLUMNS))
    q["cardinality_profile_events"] = cardinality("events", EVENTS_COLS)
    q["cardinality_profile_orders"] = cardinality("orders", ORDERS_COLS)
    q["date_range"] = W(" UNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, min({c}) AS min_date, max({c}) AS max_date, count({c}) AS non_null_count FROM incidents"
        for c in ["date_occ", "date_rptd"]))
    q["illogical_dates"] = _count_pct("illogical_dates", "date_rptd < date_occ")
    q["illogical_dates_sample"] = _sample("date_rptd < date_occ", ["dr_no", "date_rptd", "date_occ", "crm_cd_desc"])
    q["lag_stats"] = W(f"""SELECT min(lag) AS min_days, max(lag) AS max_days, round(avg(lag), 4) AS avg_days,
  quantile_cont(lag, 0.5) AS median_days, quantile_cont(lag, 0.9) AS p90_days FROM (SELECT {LAG} AS lag FROM incidents)""")
    q["lag_distribution"] = W(f"""SELECT days_to_report, count(*) AS "count" FROM (SELECT {LAG} AS days_to_report FROM incidents)
GROUP BY days_to_report ORDER BY days_to_report ASC NULLS FIRST LIMIT 20""")
    q["time_validity"] = W(f"""SELECT count(*) FILTER (WHERE time_occ < 0 OR time_occ > 2359) AS invalid_times,
  count(*) FILTER (WHERE {HOUR} > 23 OR {HOUR} < 0) AS invalid_hours,
  count(*) FILTER (WHERE {MINUTE} > 59 OR {MINUTE} < 0) AS invalid_minutes FROM incidents""")
    q["hour_distribution"] = W(f'SELECT {HOUR} AS hour, count(*) AS "count" FROM incidents GROUP BY 1')
    q["future_dates"] = W(f"""SELECT count(*) FILTER (WHERE date_occ > {AS_OF}) AS future_occurrences,
  count(*) FILTER (WHERE date_rptd > {AS_OF}) AS future_reports FROM incidents""")
    q["future_dates_sample"] = _sample(f"date_occ > {AS_OF}", ["dr_no", "date_occ", "date_rptd", "crm_cd_desc"])
    q["coordinate_stats"] = W("""SELECT min(lat) AS min_lat, max(lat) AS max_lat, round(avg(lat), 6) AS avg_lat,
  min(lon) AS min_lon, max(lon) AS max_lon, round(avg(lon), 6) AS avg_lon,
  count(lat) AS non_null_lat, count(lon) AS non_null_lon FROM incidents""")
    q["coordinate_bounds"] = W(f"""SELECT *, {pct('out_of_bounds_either', 'total_rows')} AS pct_out_of_bounds FROM (
  SELECT count(*) FILTER (WHERE lat = 0 AND lon = 0) AS zero_coords,
  count(*) FILTER (WHERE {LAT_BAD}) AS out_of_bounds_lat, count(*) FILTER (WHERE {LON_BAD}) AS out_of_bounds_lon,
  count(*) FILTER (WHERE {LAT_BAD} OR {LON_BAD}) AS out_of_bounds_either, count(*) AS total_rows FROM incidents)""")
    q["coordinate_bounds_sample"] = _sample(f"({LAT_BAD} OR {LON_BAD})", ["dr_no", "lat", "lon", "location", "area_name"])
    q["area_distribution"] = W('SELECT area, area_name, count(*) AS "count" FROM incidents GROUP BY area, area_name')
    q["invalid_areas"] = W(f"""SELECT area, area_name, count(*) AS "count" FROM incidents
WHERE NOT (CAST(area AS VARCHAR) IN ({_in(str(a) for a in C.VALID_AREAS)})) GROUP BY area, area_name""")
    q["district_stats"] = W("""SELECT count(DISTINCT rpt_dist_no) AS distinct_districts, min(rpt_dist_no) AS min_district,
  max(rpt_dist_no) AS max_district FROM incidents""")
    q["top_districts"] = W('SELECT rpt_dist_no, count(*) AS "count" FROM incidents GROUP BY rpt_dist_no '
                           'ORDER BY "count" DESC, rpt_dist_no ASC NULLS LAST LIMIT 10')
    q["location_stats"] = W("""SELECT count(location) AS non_null_locations, count(DISTINCT location) AS unique_locations,
  CAST(min(length(location)) AS INTEGER) AS min_length, CAST(max(length(location)) AS INTEGER) AS max_length,
  round(avg(length(location)), 4) AS avg_length FROM incidents""")
    q["age_stats"] = W("""SELECT min(vict_age) AS min_age, max(vict_age) AS max_age, round(avg(vict_age), 4) AS avg_age,
  quantile_cont(vict_age, 0.5) AS median_age, count(vict_age) AS non_null_count FROM incidents""")
    bad_age = f"(vict_age < 0 OR vict_age > {C.DEFAULT.max_age})"
    q["age_validity"] = W(f"""SELECT *, {pct('invalid_ages', 'total_rows')} AS pct_invalid FROM (
  SELECT count(*) FILTER (WHERE vict_age < 0) AS negative_ages, count(*) FILTER (WHERE vict_age = 0) AS zero_ages,
  count(*) FILTER (WHERE vict_age > {C.DEFAULT.max_age}) AS over_max_ages,
  count(*) FILTER (WHERE {bad_age}) AS invalid_ages, count(*) AS total_rows FROM incidents)""")
    q["age_validity_sample"] = _sample(bad_age, ["dr_no", "vict_age", "vict_sex", "vict_descent", "crm_cd_desc"])
    q["age_distribution_raw"] = W(f'SELECT {RAW_BAND} AS age_group, count(*) AS "count" FROM incidents GROUP BY 1')
    share = 'round(CAST("count" AS DOUBLE) * 100.0 / sum("count") OVER (), 2) AS pct'
    q["sex_distribution"] = W(f"""SELECT vict_sex, "count", {share},
  vict_sex IS NULL OR vict_sex IN ({_in(C.PROFILE_SEX_CODES)}) AS is_expected
FROM (SELECT vict_sex, count(*) AS "count" FROM incidents GROUP BY vict_sex)""")
    known = _in(C.PROFILE_DESCENT_CODES)
    q["descent_distribution"] = W(f"""SELECT vict_descent, "count", {share},
  CASE WHEN vict_descent IN ({known}) THEN {_labels('vict_descent', C.PROFILE_DESCENT_CODES, '')} END AS descent_desc,
  vict_descent IS NULL OR vict_descent IN ({known}) AS is_expected
FROM (SELECT vict_descent, count(*) AS "count" FROM incidents GROUP BY vict_descent)""")
    q["missing_demographics"] = _count_pct("missing_demographics",
                                           "vict_age IS NULL OR vict_sex IS NULL OR vict_descent IS NULL")
    q["top_profiles"] = W(f"""SELECT age_group, vict_sex, vict_descent, count(*) AS "count" FROM (
  SELECT {RAW_BAND} AS age_group, vict_sex, vict_descent FROM incidents) GROUP BY ALL
ORDER BY "count" DESC, age_group ASC NULLS LAST, vict_sex ASC NULLS LAST, vict_descent ASC NULLS LAST LIMIT 10""")
    counters = {
        "report_before_occurrence": "date_rptd < date_occ",
        "out_of_bounds": f"{LAT_BAD} OR {LON_BAD}",
        "zero_coords": "lat = 0 AND lon = 0",
        "negative_ages": "vict_age < 0",
        "zero_ages": "vict_age = 0",
        "missing_sex_descent": "vict_sex IS NULL OR vict_descent IS NULL",
        "secondary_codes": "crm_cd_2 IS NULL",
        "missing_weapons": "weapon_used_cd IS NULL",
    }
    values = ", ".join(f"({_q(k)}, {_q(cat)}, {_q(iss)}, {_q(sev)}, {_q(act)})" for k, cat, iss, sev, act in ISSUES)
    q["issue_summary"] = W(f"""SELECT v.category, v.issue, u."count", v.severity, v.action FROM
(UNPIVOT (SELECT {', '.join(f'count(*) FILTER (WHERE {p}) AS {k}' for k, p in counters.items())} FROM incidents)
  ON {', '.join(counters)} INTO NAME k VALUE "count") u
JOIN (VALUES {values}) v(k, category, issue, severity, action) ON u.k = v.k""")
    metrics = [
        ("Unique Crime Types (crm_cd)", "count(DISTINCT crm_cd)"),
        ("LAPD Areas", "count(DISTINCT area)"),
        ("Reporting Districts", "count(DISTINCT rpt_dist_no)"),
        ("Unique Locations", "count(DISTINCT location)"),
        ("Date Range (days)", "date_diff('day', CAST(min(date_occ) AS DATE), CAST(max(date_occ) AS DATE))"),
        ("Avg Reporting Lag (days)", f"round(avg({LAG}), 2)"),
        ("Crimes with Weapons", "count(weapon_used_cd)"),
        ("Crimes without Weapons", "count(*) FILTER (WHERE weapon_used_cd IS NULL)"),
        ("Juvenile Victims (<18)", "count(*) FILTER (WHERE vict_age > 0 AND vict_age < 18)"),
        ("Senior Victims (65+)", "count(*) FILTER (WHERE vict_age >= 65 AND vict_age < 120)"),
    ]
    mvals = ", ".join(f"('m{i}', {_q(name)})" for i, (name, _) in enumerate(metrics))
    q["key_stats"] = W(f"""SELECT v.metric, u.value FROM
(UNPIVOT (SELECT {', '.join(f'CAST({e} AS DOUBLE) AS m{i}' for i, (_, e) in enumerate(metrics))} FROM incidents)
  ON {', '.join(f'm{i}' for i in range(len(metrics)))} INTO NAME k VALUE value) u
JOIN (VALUES {mvals}) v(k, metric) ON u.k = v.k""")
    q["retention"] = W(f"""SELECT rows_in, rows_failing, rows_in - rows_failing AS rows_kept,
  {pct('rows_in - rows_failing', 'rows_in')} AS pct_retained
FROM (SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({ALL_RULES})) AS rows_failing FROM incidents)""")
    # B1-B18, U1
    cnt = "count(*) AS incidents"
    yearly = f"SELECT year, {cnt} FROM {star('date_occurred')} GROUP BY year"
    q["yearly_yoy"] = W(period_change(yearly, "year", "year"))
    q["month_heatmap"] = W(f"SELECT year, month, month_name, {cnt} FROM {star('date_occurred')} GROUP BY ALL")
    quarterly = f"SELECT year, quarter, {cnt} FROM {star('date_occurred')} GROUP BY ALL"
    q["quarterly_change"] = W(period_change(quarterly, "year, quarter", "year * 4 + quarter"))
    step = C.DEFAULT.grid_step
    q["density_grid"] = W(f"""SELECT CAST(floor(round(latitude * 1000000) / {round(step * 1000000)}) AS BIGINT) AS lat_cell,
  CAST(floor(round(longitude * 1000000) / {round(step * 1000000)}) AS BIGINT) AS lon_cell, {cnt}
FROM fact WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY ALL""")
    q["top_areas"] = W(f"""SELECT area, area_name, {cnt} FROM {star('location')} GROUP BY ALL
ORDER BY incidents DESC, area ASC NULLS LAST, area_name ASC NULLS LAST LIMIT 10""")
    q["region_area"] = W(f"SELECT geographic_region, area, area_name, {cnt} FROM {star('location')} GROUP BY ALL")
    q["day_of_week"] = W(f"SELECT day_of_week, day_of_week_name, {cnt} FROM {star('date_occurred')} GROUP BY ALL")
    q["hour_of_day"] = W(f"SELECT hour, {cnt} FROM {star('time')} GROUP BY ALL")
    q["type_by_period"] = W(f"SELECT crm_cd, crm_cd_desc, time_period, {cnt} FROM {star('crime_type', 'time')} GROUP BY ALL")
    q["top_weapons"] = W(f"""SELECT weapon_used_cd, weapon_desc, {cnt} FROM {star('weapon')}
WHERE weapon_key <> {C.NO_WEAPON_KEY} GROUP BY ALL
ORDER BY incidents DESC, weapon_used_cd ASC NULLS LAST, weapon_desc ASC NULLS LAST LIMIT 20""")
    names = [label for _, label in C.WEAPON_CATEGORIES] + [C.WEAPON_OTHER, C.WEAPON_NONE]
    q["weapon_category_share"] = W(f"""SELECT weapon_category, incidents, {pct('incidents', '__n')} AS pct_share FROM
(UNPIVOT (SELECT count(*) AS __n, {', '.join(f'count(*) FILTER (WHERE {WEAPON_CAT} = {_q(n)}) AS "{n}"' for n in names)}
  FROM {star('weapon')}) ON {', '.join(f'"{n}"' for n in names)} INTO NAME weapon_category VALUE incidents)""")
    q["weapon_trend"] = W(f"SELECT year_month, {cnt} FROM {star('date_occurred')} WHERE is_weapon_involved GROUP BY ALL")
    q["age_groups"] = W(f"SELECT age_group, {cnt} FROM {star('victim')} GROUP BY ALL")
    q["sex_breakdown"] = W(f"SELECT sex_desc, {cnt} FROM {star('victim')} GROUP BY ALL")
    q["descent_breakdown"] = W(f"SELECT descent_desc, {cnt} FROM {star('victim')} GROUP BY ALL")
    q["arrest_rate"] = W(f"""SELECT incidents, arrests, {pct('arrests', 'incidents')} AS arrest_rate_pct FROM (
  SELECT {cnt}, count(*) FILTER (WHERE coalesce(is_arrested, false)) AS arrests FROM fact)""")
    q["arrest_by_status"] = W(f"""SELECT status, status_desc, {cnt} FROM {star('status')}
WHERE status IN ({_in(C.ARREST_STATUSES)}) GROUP BY ALL""")
    q["arrest_trend_area"] = W(f"""SELECT area, area_name, year_month, incidents, arrests, {pct('arrests', 'incidents')} AS arrest_rate_pct
FROM (SELECT area, area_name, year_month, {cnt}, count(*) FILTER (WHERE coalesce(is_arrested, false)) AS arrests
      FROM {star('location', 'date_occurred')} GROUP BY ALL)""")
    for name in MARTS:
        q[f"refreshed_{name}"] = q[name]
    for name in MERGED_REPORTS:
        q[f"merged_{name}"] = q[name]
    ctes, exact = q["cardinality_profile"].split("\n)\nSELECT ", 1)
    q["sketched_cardinality"] = (f"{ctes}\n)\nSELECT column_name, distinct_count AS exact_count, total_records, true AS within_error "
                                 f"FROM (SELECT {exact})")
    q["layer_counts"] = W("""SELECT 'Bronze' AS layer, count(*) AS "rows" FROM bronze
UNION ALL SELECT 'Silver', count(*) FROM silver UNION ALL SELECT 'Fact', count(*) FROM fact""")
    return q
