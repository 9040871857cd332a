"""Fact build (J1-J9, G3) and the star read-back.

Shape of the plan: the silver rows stream through nine left outer joins
against dimension tables. Every dimension is tiny next to the fact (thousands
of rows), so each join is a broadcast hash join where the dimension's rows
(counted when its table was written) and bytes are within bounds: the fact is
never shuffled, and a hot key on the fact side (e.g. the "no weapon" member
holding most rows) costs nothing. Beyond the bounds the join shuffles, known
hot keys are dealt over all partitions, and AQE splits other skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keys import incident_key
from ..plans.execution import broadcast_known


def star_join(facts: DataFrame, dim: DataFrame, on: Sequence[tuple[Column, str]],
              keep: Mapping[str, str], label: str, null_safe: bool = False,
              cfg: C.Config = C.DEFAULT, known_rows: int | None = None, hot: Sequence = ()) -> DataFrame:
    """Left join ``facts`` with ``dim`` on ``(fact expression, dim column)`` pairs.

    Only the key columns and the ``keep`` columns (renamed ``src -> dst``) of
    the dimension are read. ``null_safe`` compares with ``<=>`` so NULL
    parts match the NULL member; Catalyst still turns it into hashable
    equi-join keys. ``known_rows`` is the dimension's size, known by
    construction (the spines) or counted when its table was written.

    A dimension within the bounds of ``cfg`` is broadcast. Otherwise the join
    shuffles: rows with a key listed in ``hot`` (values of the first pair) are
    dealt over as many places as there are shuffle partitions by a hash of the
    fact row, so a repeated task deals alike, and only the dimension rows of
    those keys are repeated there. Each fact row meets one copy of its member.
    """
    kcols = [f"__{label}_k{i}" for i in range(len(on))]
    side = dim.select(*[F.col(dc).alias(k) for (_, dc), k in zip(on, kcols)],
                      *[F.col(src).alias(dst) for src, dst in keep.items()])
    bound = broadcast_known(side, known_rows, cfg.broadcast_max_rows, cfg.broadcast_max_bytes)
    salted = bound is side and bool(hot)
    salt = f"__{label}_salt"
    if salted:
        n = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        places = F.sequence(F.lit(0), F.when(side[kcols[0]].isin(list(hot)), n - 1).otherwise(0))
        bound = side.withColumn(salt, F.explode(places))
        dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(n)).cast("int")
        facts = facts.withColumn(salt, F.when(on[0][0].isin(list(hot)), dealt).otherwise(0))
    cond = None
    for (fe, _), k in zip(on, kcols):
        c = fe.eqNullSafe(bound[k]) if null_safe else (fe == bound[k])
        cond = c if cond is None else cond & c
    if salted:
        cond = cond & (facts[salt] == bound[salt])
    out = facts.join(bound, cond, "left").drop(*kcols)
    return out.drop(facts[salt], bound[salt]) if salted else out


MINUTES_PER_DAY = 1440


def spine_days(cfg: C.Config) -> int:
    """Rows of the date dimension: fixed by the configured range."""
    return (date.fromisoformat(cfg.date_end) - date.fromisoformat(cfg.date_start)).days + 1


# The fact's columns in order.
FACT_COLUMNS = [
    "incident_key", "dr_no",
    "date_occurred_key", "date_reported_key", "time_occurred_key", "location_key",
    "crime_type_key", "victim_demographic_key", "premise_key", "weapon_key", "status_key",
    "location_address", "cross_street", "latitude", "longitude", "mocodes",
    "days_to_report", "crime_count",
    "is_weapon_involved", "is_juvenile_victim", "is_arrested",
    "bronze_load_datetime", "silver_processed_datetime", "gold_processed_datetime", "created_by",
]
FOREIGN_KEYS = FACT_COLUMNS[2:11]
AUDIT_COLUMNS = ["bronze_load_datetime", "silver_processed_datetime", "gold_processed_datetime"]


def attach_foreign_keys(silver: DataFrame, dims: Mapping[str, DataFrame],
                        cfg: C.Config = C.DEFAULT, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """The nine left joins, adding one foreign key each. ``sizes``: rows
    per dimension where known. A dimension that is not given adds none."""
    known = {**(sizes or {}), "dim_date": spine_days(cfg), "dim_time": MINUTES_PER_DAY}
    weapon = F.coalesce(F.col("weapon_used_cd"), F.lit(C.NO_WEAPON_CODE))
    victim = [(F.col(c), c) for c in ("vict_age_clean", "vict_sex", "vict_descent")]
    # (dimension, pairs, dimension key, fact column, role)
    joins = [
        ("dim_date", [(F.col("date_occ").cast("date"), "full_date")], "date_key", "date_occurred_key", "date_occ"),
        ("dim_date", [(F.col("date_rptd").cast("date"), "full_date")], "date_key", "date_reported_key", "date_rptd"),
        ("dim_time", [(F.col("time_occ"), "time_occ")], "time_key", "time_occurred_key", "time"),
        ("dim_location", [(F.col("area"), "area"), (F.col("rpt_dist_no"), "rpt_dist_no")],
         "location_key", "location_key", "location"),
        ("dim_crime_type", [(F.col("crm_cd"), "crm_cd")], "crime_type_key", "crime_type_key", "crime"),
        ("dim_victim_demographics", victim, "victim_demographic_key", "victim_demographic_key", "victim"),
        ("dim_premise", [(F.col("premis_cd"), "premis_cd")], "premise_key", "premise_key", "premise"),
        ("dim_weapon", [(weapon, "weapon_used_cd")], "weapon_key", "weapon_key", "weapon"),
        ("dim_status", [(F.col("status"), "status")], "status_key", "status_key", "status"),
    ]
    f = silver
    for name, on, key, column, role in joins:
        if name not in dims:
            continue
        f = star_join(f, dims[name], on, {key: column}, role, null_safe=role == "victim", cfg=cfg,
                      known_rows=known.get(name), hot=cfg.hot_keys.get(role, ()))
    return f


def fact_incidents(silver: DataFrame, dims: Mapping[str, DataFrame], cfg: C.Config = C.DEFAULT,
                   ts: Column | None = None, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """One row per silver row: surrogate key, business key, nine foreign
    keys, degenerate columns, measures, flags and audit (25 columns)."""
    return attach_foreign_keys(silver, dims, cfg, sizes).select(*fact_columns(cfg, ts))


def fact_columns(cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> list:
    """The fact's columns over silver rows with their foreign keys."""
    return [
        incident_key(F.col("dr_no"), cfg.key_mode).alias("incident_key"),
        "dr_no", *FOREIGN_KEYS,
        F.col("location").alias("location_address"),
        "cross_street",
        F.col("lat_clean").alias("latitude"),
        F.col("lon_clean").alias("longitude"),
        "mocodes", "days_to_report",
        F.lit(1).alias("crime_count"),
        "is_weapon_involved", "is_juvenile_victim", "is_arrested",
        F.col("ingestion_datetime").alias("bronze_load_datetime"),
        "silver_processed_datetime",
        (ts if ts is not None else F.current_timestamp()).alias("gold_processed_datetime"),
        F.lit(C.FLOW_FACT).alias("created_by"),
    ]


def fact_null_fk_counts(fact: DataFrame) -> DataFrame:
    """Rows with a NULL foreign key, per foreign key (one aggregate pass)."""
    one = fact.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in FOREIGN_KEYS],
                   F.count(F.lit(1)).alias("__n"))
    return one.unpivot("__n", FOREIGN_KEYS, "foreign_key", "null_rows").select(
        "foreign_key", "null_rows", F.col("__n").alias("fact_rows"))


# ---------------------------------------------------------------- J10 star
# role -> (dimension, fact key, dimension key, {dimension column: star column})
STAR_ROLES: dict[str, tuple[str, str, str, dict[str, str]]] = {
    "date_occurred": ("dim_date", "date_occurred_key", "date_key", {
        c: c for c in ["full_date", "year", "quarter", "year_quarter", "month", "month_name",
                       "year_month", "day", "day_of_week", "day_of_week_name", "week_of_year",
                       "is_weekend", "fiscal_year", "fiscal_quarter"]}),
    "date_reported": ("dim_date", "date_reported_key", "date_key", {
        c: f"reported_{c}" for c in ["full_date", "year", "month", "year_month"]}),
    "time": ("dim_time", "time_occurred_key", "time_key", {
        c: c for c in ["hour", "minute", "time_period", "time_period_detail",
                       "hour_of_day_category", "is_business_hours", "is_peak_hours"]}),
    "location": ("dim_location", "location_key", "location_key", {
        c: c for c in ["area", "area_name", "rpt_dist_no", "geographic_region"]}),
    "crime_type": ("dim_crime_type", "crime_type_key", "crime_type_key", {
        c: c for c in ["crm_cd", "crm_cd_desc", "part_1_2", "crime_category", "is_violent"]}),
    "victim": ("dim_victim_demographics", "victim_demographic_key", "victim_demographic_key", {
        c: c for c in ["vict_age_clean", "age_group", "vict_sex", "sex_desc", "vict_descent", "descent_desc"]}),
    "premise": ("dim_premise", "premise_key", "premise_key", {
        c: c for c in ["premis_cd", "premis_desc", "premise_category"]}),
    "weapon": ("dim_weapon", "weapon_key", "weapon_key", {
        c: c for c in ["weapon_used_cd", "weapon_desc", "weapon_category"]}),
    "status": ("dim_status", "status_key", "status_key", {c: c for c in ["status", "status_desc"]}),
}


def star_view(fact: DataFrame, dims: Mapping[str, DataFrame], roles: Sequence[str] | None = None,
              cfg: C.Config = C.DEFAULT, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """The fact with the attributes of the requested dimension roles.

    Joins on surrogate keys (left, broadcast where the size is known). Only the
    requested roles are joined, and only their listed columns present in the
    dimension are read.
    """
    out = fact
    known = {**(sizes or {}), "dim_date": spine_days(cfg), "dim_time": MINUTES_PER_DAY}
    for role in (list(STAR_ROLES) if roles is None else roles):
        dim_name, fk, dk, cols = STAR_ROLES[role]
        dim = dims[dim_name]
        keep = {s: d for s, d in cols.items() if s in dim.columns}
        out = star_join(out, dim, [(F.col(fk), dk)], keep, role, cfg=cfg, known_rows=known.get(dim_name))
    return out
