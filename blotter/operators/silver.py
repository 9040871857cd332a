"""Silver enrichment (E1-E10). Each step is a narrow projection over the
bronze record; ``silver`` fuses them into a single ``withColumns`` stage plus
the quality gate, and runs unchanged on batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from ..functions.audit import load_audit
from .quality import expect_all_or_drop


def clean_age_expr(cfg: C.Config = C.DEFAULT) -> Column:
    a = F.col("vict_age")
    return F.when(a < 0, None).when(a > cfg.max_age, None).otherwise(a)


def clean_age(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Ages below 0 or above ``max_age`` become NULL."""
    return df.withColumn("vict_age_clean", clean_age_expr(cfg))


def clean_coords_exprs() -> dict[str, Column]:
    zero = (F.col("lat") == 0) & (F.col("lon") == 0)
    return {
        "lat_clean": F.when(zero, None).otherwise(F.col("lat")),
        "lon_clean": F.when(zero, None).otherwise(F.col("lon")),
    }


def clean_coords(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """A (0, 0) pair becomes NULL in both; out-of-bounds values are kept
    (see ``out_of_bounds_flag`` to flag them)."""
    return df.withColumns(clean_coords_exprs())


def age_group_expr(age_clean: Column | str = "vict_age_clean") -> Column:
    a = F.col(age_clean) if isinstance(age_clean, str) else age_clean
    return X.bucketize(a, C.SILVER_AGE_BANDS, C.SILVER_AGE_TOP,
                       first=[(a.isNull(), C.AGE_UNKNOWN), (a == 0, C.AGE_UNKNOWN)])


def age_group(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Age band of the cleaned age; NULL and 0 are Unknown."""
    if "vict_age_clean" not in df.columns:
        df = clean_age(df, cfg)
    return df.withColumn("age_group", age_group_expr())


def time_parts(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """``time_str`` (HHMM text), ``hour`` and ``minute`` (NULL if unparsable)."""
    df = df.withColumn("time_str", X.hhmm_text("time_occ"))
    return df.withColumns({"hour": X.hhmm_hour("time_str"), "minute": X.hhmm_minute("time_str")})


def time_period(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """E5: Night / Morning / Afternoon / Evening (NULL hour is Evening)."""
    if "hour" not in df.columns:
        df = time_parts(df, cfg)
    return df.withColumn("time_period", X.time_period("hour"))


def days_to_report_expr() -> Column:
    return F.datediff(F.col("date_rptd"), F.col("date_occ"))


def days_to_report(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Calendar days from occurrence to report."""
    return df.withColumn("days_to_report", days_to_report_expr())


def flag_exprs() -> dict[str, Column]:
    return {
        "is_weapon_involved": F.col("weapon_used_cd").isNotNull(),
        "is_juvenile_victim": F.when(F.col("vict_age_clean") < 18, True).otherwise(False),
        "is_arrested": F.col("status").isin(C.ARREST_STATUSES),
    }


def incident_flags(df: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Weapon present; juvenile victim (NULL age -> false, age 0 -> true);
    arrested (NULL status -> NULL)."""
    if "vict_age_clean" not in df.columns:
        df = clean_age(df, cfg)
    return df.withColumns(flag_exprs())


def enrich(df: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None) -> DataFrame:
    """E1-E9 plus the silver audit columns, as two projections."""
    time_str = X.hhmm_text("time_occ")
    hour = X.hhmm_hour(time_str)
    first = {
        "vict_age_clean": clean_age_expr(cfg),
        **clean_coords_exprs(),
        "time_str": time_str,
        "hour": hour,
        "minute": X.hhmm_minute(time_str),
        "days_to_report": days_to_report_expr(),
    }
    df = df.withColumns(first)
    return df.withColumns({
        "age_group": age_group_expr(),
        "time_period": X.time_period("hour"),
        **flag_exprs(),
        **load_audit(C.FLOW_SILVER, ts, "silver_processed_datetime"),
    })


def silver(bronze: DataFrame, cfg: C.Config = C.DEFAULT, ts: Column | None = None,
           observe_name=None) -> DataFrame:
    """Quality gate (drop rows failing any rule; NULL fails) + E1-E9.

    The gate only reads source columns, so Catalyst pushes it into the scan.
    ``observe_name`` (a name, or a ``pyspark.sql.Observation`` for batch)
    attaches per-rule failure counts as observed metrics, computed while the
    rows are written.
    """
    kept = expect_all_or_drop(bronze, cfg.rules, observe_name=observe_name)
    return enrich(kept, cfg, ts)
