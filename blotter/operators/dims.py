"""Gold dimensions (D1-D8), deduplication (A12) and opt-in columns.

Data-derived dimensions are a grouping of the silver rows by the natural key:
a partial aggregation per partition collapses even a key holding a third of
all rows to one row per task before the shuffle, so hot keys cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..functions.audit import load_audit
from ..functions.keys import surrogate_key
from ..sources.spines import date_spine, minute_spine


# ---------------------------------------------------------------- A12 dedup
def dedup(df: DataFrame, keys: Sequence[str], payload: Sequence[str] = ()) -> DataFrame:
    """One row per distinct ``keys`` (NULL is a key value of its own).

    Batch: first ``distinct()`` over (keys, payload) - a hash aggregate whose
    per-task partial aggregation collapses a hot key before the shuffle -
    then, over those few distinct pairs only, the smallest payload per key
    (``min`` of a struct in which each value comes after a flag for NULL, so a
    known text wins over a missing one), so the result is deterministic. (``min`` over a
    struct or string cannot use a hash aggregate; applied to all rows it
    would sort the whole input.) Streaming: first row seen wins
    (``dropDuplicates``; state is one entry per key).
    """
    if df.isStreaming:
        return df.select(*keys, *payload).dropDuplicates(list(keys))
    pairs = df.select(*keys, *payload).distinct()
    if not payload:
        return pairs
    # __variants counts the different payloads of a key (always >= 1). It is
    # sensitive to duplicates, so referencing it keeps Catalyst from folding
    # the distinct into this aggregate (which would sort every input row).
    ranked = [c for p in payload for c in (F.col(p).isNull().alias(f"__no_{p}"), F.col(p))]
    agg = (pairs.groupBy(*keys)
           .agg(F.min(F.struct(*ranked)).alias("__p"), F.count(F.lit(1)).alias("__variants"))
           .filter(F.col("__variants") > 0))
    return agg.select(*keys, *[F.col(f"__p.{p}").alias(p) for p in payload])


def _audit(flow: str, ts: Column | None) -> dict[str, Column]:
    return load_audit(flow, ts, "created_date")


# ---------------------------------------------------------------- D1 date
def dim_date(spark: SparkSession, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """One row per day of [date_start, date_end], 21 calendar columns.

    Fiscal year starts in ``cfg.fiscal_start_month`` (October by default;
    O4: 7 for July): months from the start month on belong to the next
    fiscal year, and fiscal quarters count from the start month.
    """
    d = F.col("full_date")
    s = cfg.fiscal_start_month
    month, year, dow = F.month(d), F.year(d), F.dayofweek(d)
    fiscal_year = year if s == 1 else F.when(month >= s, year + 1).otherwise(year)
    cols = [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d.alias("full_date"),
        year.alias("year"),
        F.date_format(d, "yyyy").alias("year_name"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.concat(year.cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_name_short"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).alias("day"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.date_format(d, "EEE").alias("day_of_week_short"),
        F.weekofyear(d).alias("week_of_year"),
        F.ceil(F.dayofmonth(d) / 7).cast("int").alias("week_of_month"),
        dow.isin(1, 7).alias("is_weekend"),
        dow.isin(2, 3, 4, 5, 6).alias("is_weekday"),
        fiscal_year.alias("fiscal_year"),
        (F.floor(((month - s + 12) % 12) / 3) + 1).cast("int").alias("fiscal_quarter"),
    ]
    return date_spine(spark, cfg.date_start, cfg.date_end).select(*cols)


# ---------------------------------------------------------------- D2 time
def dim_time(spark: SparkSession, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """1,440 minutes of the day; key is HHMM as an int."""
    m = F.col("minutes_since_midnight")
    hour = (m / 60).cast("int")
    minute = (m % 60).cast("int")
    base = minute_spine(spark).select(m, hour.alias("hour"), minute.alias("minute"))
    h, mi = F.col("hour"), F.col("minute")
    hour_12 = F.when(h == 0, 12).when(h > 12, h - 12).otherwise(h)
    am_pm = F.when(h < 12, "AM").otherwise("PM")
    lo, hi = C.BUSINESS_CATEGORY_HOURS
    category = (F.when(h.isin(C.MORNING_PEAK_HOURS), "Morning Peak")
                .when(h.isin(C.EVENING_PEAK_HOURS), "Evening Peak")
                .when((h >= lo) & (h <= hi), "Business Hours")
                .when((h >= 20) | (h <= 5), "Off Hours")
                .otherwise("Other"))
    blo, bhi = C.BUSINESS_FLAG_HOURS
    time_occ = (h * 100 + mi).cast("int")
    audit = _audit("dim_time", ts)
    return base.select(
        time_occ.alias("time_key"),
        time_occ.alias("time_occ"),
        h, mi, m,
        F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":"), F.lpad(mi.cast("string"), 2, "0")).alias("time_24hr"),
        F.concat(hour_12.cast("string"), F.lit(":"), F.lpad(mi.cast("string"), 2, "0"), F.lit(" "), am_pm).alias("time_12hr"),
        hour_12.alias("hour_12"),
        am_pm.alias("am_pm"),
        X.time_period(h).alias("time_period"),
        X.hour_band(h, C.TIME_PERIOD_DETAIL, C.TIME_PERIOD_DETAIL_OTHER).alias("time_period_detail"),
        category.alias("hour_of_day_category"),
        ((h >= blo) & (h <= bhi)).alias("is_business_hours"),
        h.isin(C.MORNING_PEAK_HOURS + C.EVENING_PEAK_HOURS).alias("is_peak_hours"),
        audit["created_by"].alias("created_by"),
        audit["created_date"].alias("created_date"),
    )


# ---------------------------------------------------------------- D3-D8
def dim_status(silver: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """D3: non-null status codes; key = hash(status) % 1e6."""
    d = dedup(silver.filter(F.col("status").isNotNull()), ["status"], ["status_desc"])
    return d.select(
        surrogate_key(F.col("status"), cfg.modulus(C.MOD_SMALL), cfg.key_mode).alias("status_key"),
        "status", "status_desc", *[v.alias(k) for k, v in _audit("dim_status_flow", ts).items()])


def dim_location(silver: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """(area, district) members of non-null areas with their region;
    key = hash('area_district') % 1e7 (a NULL district gives a NULL text)."""
    d = dedup(silver.filter(F.col("area").isNotNull()), ["area", "rpt_dist_no"], ["area_name"])
    text = F.concat(F.col("area").cast("string"), F.lit("_"), F.col("rpt_dist_no").cast("string"))
    return d.select(
        surrogate_key(text, cfg.modulus(C.MOD_LARGE), cfg.key_mode).alias("location_key"),
        "area", "area_name", "rpt_dist_no",
        X.region_of("area").alias("geographic_region"),
        *[v.alias(k) for k, v in _audit("dim_location_flow", ts).items()])


def dim_premise(silver: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """Non-null premise codes with an ordered regex category; key % 1e6."""
    d = dedup(silver.filter(F.col("premis_cd").isNotNull()), ["premis_cd"], ["premis_desc"])
    return d.select(
        surrogate_key(F.col("premis_cd"), cfg.modulus(C.MOD_SMALL), cfg.key_mode).alias("premise_key"),
        "premis_cd", "premis_desc",
        X.regex_category("premis_desc", C.PREMISE_CATEGORIES, C.PREMISE_OTHER).alias("premise_category"),
        *[v.alias(k) for k, v in _audit("dim_premise_flow", ts).items()])


def weapon_category_expr(code: Column | str = "weapon_used_cd", desc: Column | str = "weapon_desc") -> Column:
    """O1: Firearm / Knife / Blunt / Body / Other by description; NULL code is None."""
    c = F.col(code) if isinstance(code, str) else code
    return F.when(c.isNull(), C.WEAPON_NONE).otherwise(
        X.regex_category(desc, C.WEAPON_CATEGORIES, C.WEAPON_OTHER))


def dim_weapon(silver: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """Weapon codes; the NULL code is kept as the member
    (-1, -1.0, 'No Weapon'). Others: key = hash(code) % 1e6."""
    d = dedup(silver, ["weapon_used_cd"], ["weapon_desc"])
    code = F.col("weapon_used_cd")
    cols = [
        F.when(code.isNull(), F.lit(C.NO_WEAPON_KEY).cast("bigint"))
         .otherwise(surrogate_key(code, cfg.modulus(C.MOD_SMALL), cfg.key_mode)).alias("weapon_key"),
        F.coalesce(code, F.lit(C.NO_WEAPON_CODE)).alias("weapon_used_cd"),
        F.when(code.isNull(), C.NO_WEAPON_DESC).otherwise(F.col("weapon_desc")).alias("weapon_desc"),
    ]
    if cfg.weapon_category:
        cols.append(weapon_category_expr(code, "weapon_desc").alias("weapon_category"))
    return d.select(*cols, *[v.alias(k) for k, v in _audit("dim_weapon_flow", ts).items()])


def crime_category_expr(desc: Column | str = "crm_cd_desc") -> Column:
    """O2: Violent / Property / Drug / Other by description."""
    return X.regex_category(desc, C.CRIME_CATEGORIES, C.CRIME_OTHER)


def dim_crime_type(silver: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """Non-null crime codes with description and part; key % 1e6."""
    d = dedup(silver.filter(F.col("crm_cd").isNotNull()), ["crm_cd"], ["crm_cd_desc", "part_1_2"])
    cols = [surrogate_key(F.col("crm_cd"), cfg.modulus(C.MOD_SMALL), cfg.key_mode).alias("crime_type_key"),
            "crm_cd", "crm_cd_desc", "part_1_2"]
    if cfg.crime_category:
        cat = crime_category_expr()
        cols += [cat.alias("crime_category"), (cat == "Violent").alias("is_violent")]
    return d.select(*cols, *[v.alias(k) for k, v in _audit("dim_crime_type_flow", ts).items()])


def victim_text(age: Column, sex: Column, descent: Column) -> Column:
    """'age_sex_descent' with the text 'null' standing in for NULL parts."""
    return F.concat(F.coalesce(age.cast("string"), F.lit("null")), F.lit("_"),
                    F.coalesce(sex, F.lit("null")), F.lit("_"),
                    F.coalesce(descent, F.lit("null")))


def dim_victim(silver: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """(clean age, sex, descent) members, NULLs kept; labels for sex and
    descent; key = hash('age_sex_descent') % 1e7."""
    d = dedup(silver, ["vict_age_clean", "vict_sex", "vict_descent"], ["age_group"])
    return d.select(
        surrogate_key(victim_text(F.col("vict_age_clean"), F.col("vict_sex"), F.col("vict_descent")),
                      cfg.modulus(C.MOD_LARGE), cfg.key_mode).alias("victim_demographic_key"),
        "vict_age_clean", "age_group", "vict_sex",
        X.code_label("vict_sex", C.SEX_LABELS, C.LABEL_UNKNOWN).alias("sex_desc"),
        "vict_descent",
        X.code_label("vict_descent", C.DESCENT_LABELS, C.LABEL_UNKNOWN).alias("descent_desc"),
        *[v.alias(k) for k, v in _audit("dim_victim_demographics_flow", ts).items()])


DATA_DIMS = {
    "dim_status": dim_status,
    "dim_location": dim_location,
    "dim_premise": dim_premise,
    "dim_weapon": dim_weapon,
    "dim_crime_type": dim_crime_type,
    "dim_victim_demographics": dim_victim,
}

# Natural keys of each dimension (for collision and uniqueness checks).
NATURAL_KEYS = {
    "dim_status": ("status_key", ["status"]),
    "dim_location": ("location_key", ["area", "rpt_dist_no"]),
    "dim_premise": ("premise_key", ["premis_cd"]),
    "dim_weapon": ("weapon_key", ["weapon_used_cd"]),
    "dim_crime_type": ("crime_type_key", ["crm_cd"]),
    "dim_victim_demographics": ("victim_demographic_key", ["vict_age_clean", "vict_sex", "vict_descent"]),
}


# (natural key columns, payload columns) read from silver by each dimension.
DIM_COLUMNS = {
    "dim_status": (["status"], ["status_desc"]),
    "dim_location": (["area", "rpt_dist_no"], ["area_name"]),
    "dim_premise": (["premis_cd"], ["premis_desc"]),
    "dim_weapon": (["weapon_used_cd"], ["weapon_desc"]),
    "dim_crime_type": (["crm_cd"], ["crm_cd_desc", "part_1_2"]),
    "dim_victim_demographics": (["vict_age_clean", "vict_sex", "vict_descent"], ["age_group"]),
}


def _member_columns() -> list[str]:
    cols: list[str] = []
    for k, p in DIM_COLUMNS.values():
        cols += [c for c in [*k, *p] if c not in cols]
    return cols


def dimension_members(silver: DataFrame) -> DataFrame:
    """Distinct (key, payload) pairs of all six data dimensions from one pass.

    One ``GROUPING SETS`` aggregate with a set (natural key + payload) per
    dimension and no aggregate buffers, so it is a pure hash aggregate whose
    per-task partial collapses hot keys before the shuffle. ``__gid`` tells
    the sets apart; each dimension then picks its payload from these few rows.
    """
    cols = _member_columns()
    return (silver.groupingSets([[F.col(c) for c in [*k, *p]] for k, p in DIM_COLUMNS.values()],
                                *[F.col(c) for c in cols])
            .agg(F.grouping_id().alias("__gid")))


def _members_of(members: DataFrame, name: str) -> DataFrame:
    cols = _member_columns()
    k, payload = DIM_COLUMNS[name]
    present = [*k, *payload]
    gid = sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in present)
    return members.filter(F.col("__gid") == gid).select(*present)


def build_dims(spark: SparkSession, silver: DataFrame, cfg: C.Config = C.DEFAULT,
               ts: Column | None = None, fused: bool = False) -> dict[str, DataFrame]:
    """All eight dimensions as DataFrames (nothing is computed here).

    ``fused=True`` derives the six data dimensions from one persisted
    ``dimension_members`` pass instead of one aggregation of silver each
    (batch silver only; the builders then run on the small member frames, so
    the results are identical). It saves jobs on small inputs; on large ones
    the separate aggregations are cheaper: they read disjoint columns anyway,
    and they do not expand every row six times with the wider keys of all
    dimensions.
    """
    out = {"dim_date": dim_date(spark, cfg), "dim_time": dim_time(spark, cfg, ts)}
    members = dimension_members(silver).persist() if fused and not silver.isStreaming else None
    for name, fn in DATA_DIMS.items():
        out[name] = fn(silver if members is None else _members_of(members, name), cfg, ts)
    return out


def out_of_bounds_flag(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """O3: flag coordinates outside the bounding box but keep the rows."""
    lat_lo, lat_hi = cfg.lat_bounds
    lon_lo, lon_hi = cfg.lon_bounds
    flag = X.out_of_range("lat", lat_lo, lat_hi) | X.out_of_range("lon", lon_lo, lon_hi)
    return df.withColumn("is_out_of_bounds", F.coalesce(flag, F.lit(False)))
