"""Dashboard marts over the star (B1-B18) and layer counts.

Each mart takes the star view (fact joined to the dimension roles it needs, or
facts already counted by foreign key, with their counts in ``WEIGHT``) and
returns a small aggregate. Shares are computed by conditional
aggregation in a single pass instead of joining against a total, and
period-over-period changes join aggregated periods by index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import expressions as X
from .aggregates import period_change, top_k, union_counts, value_counts

N = "incidents"
#: In a star of counted facts: the incidents that a row stands for.
WEIGHT = "_incidents"


def _total(star: DataFrame, pred: Column | None = None) -> Column:
    """Incidents (that meet ``pred``) of a group."""
    if WEIGHT not in star.columns:
        return F.count(F.lit(1)) if pred is None else F.count_if(pred)
    return F.coalesce(F.sum(WEIGHT if pred is None else F.when(pred, F.col(WEIGHT))), F.lit(0).cast("bigint"))


def _count(df: DataFrame, keys: list[str]) -> DataFrame:
    if WEIGHT not in df.columns:
        return value_counts(df, keys, N)
    return df.groupBy(*keys).agg(_total(df).alias(N))


def yearly_yoy(star: DataFrame) -> DataFrame:
    """B1: incidents per year of occurrence with change vs the previous year."""
    per_year = _count(star, ["year"])
    return period_change(per_year, F.col("year"), N)


def month_heatmap(star: DataFrame) -> DataFrame:
    """B2: incidents per (year, month)."""
    return _count(star, ["year", "month", "month_name"])


def quarterly_change(star: DataFrame) -> DataFrame:
    """Incidents per (year, quarter) with change vs the previous quarter."""
    per_q = _count(star, ["year", "quarter"])
    return period_change(per_q, F.col("year") * 4 + F.col("quarter"), N)


def density_grid(star: DataFrame, cfg: C.Config = C.DEFAULT) -> DataFrame:
    """Incidents per lat/lon grid cell of ``grid_step`` degrees (cell
    index = floor(coordinate / step)); rows without coordinates skipped.

    Coordinates and step are taken as whole millionths of a degree, so that a
    point on a cell's edge falls into that cell."""
    step = round(cfg.grid_step * 1_000_000)

    def cell(c: str):
        return F.floor(F.round(F.col(c) * 1_000_000).cast("bigint") / step)

    cells = star.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        cell("latitude").alias("lat_cell"), cell("longitude").alias("lon_cell"),
        *[c for c in star.columns if c == WEIGHT])
    return _count(cells, ["lat_cell", "lon_cell"])


def top_areas(star: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` areas with most incidents."""
    return top_k(_count(star, ["area", "area_name"]), ["area", "area_name"], k, N)


def region_area(star: DataFrame) -> DataFrame:
    """Incidents per region and area (tree map)."""
    return _count(star, ["geographic_region", "area", "area_name"])


def day_of_week(star: DataFrame) -> DataFrame:
    """Incidents per day of week (1 = Sunday)."""
    return _count(star, ["day_of_week", "day_of_week_name"])


def hour_of_day(star: DataFrame) -> DataFrame:
    """Incidents per hour of the time dimension."""
    return _count(star, ["hour"])


def type_by_period(star: DataFrame) -> DataFrame:
    """Incidents per crime type and time period."""
    return _count(star, ["crm_cd", "crm_cd_desc", "time_period"])


def top_weapons(star: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most used weapons (the 'No Weapon' member excluded)."""
    used = star.filter(F.col("weapon_key") != C.NO_WEAPON_KEY)
    return top_k(_count(used, ["weapon_used_cd", "weapon_desc"]), ["weapon_used_cd", "weapon_desc"], k, N)


def weapon_category_share(star: DataFrame) -> DataFrame:
    """Incidents and % share per weapon category (O1).

    One global aggregate counts every category at once, then the single row
    is unpivoted, so the total never needs a join or a window.
    """
    cat = star["weapon_category"] if "weapon_category" in star.columns else None
    if cat is None:
        from .dims import weapon_category_expr
        code = F.when(F.col("weapon_key") != C.NO_WEAPON_KEY, F.col("weapon_used_cd"))
        cat = weapon_category_expr(code, "weapon_desc")
    names = [label for _, label in C.WEAPON_CATEGORIES] + [C.WEAPON_OTHER, C.WEAPON_NONE]
    one = star.agg(_total(star).alias("__n"), *[_total(star, cat == n).alias(n) for n in names])
    long = one.unpivot("__n", names, "weapon_category", N)
    return long.select("weapon_category", N, X.pct(F.col(N), F.col("__n")).alias("pct_share"))


def weapon_trend(star: DataFrame) -> DataFrame:
    """Incidents involving a weapon per month."""
    return _count(star.filter(F.col("is_weapon_involved")), ["year_month"])


def age_groups(star: DataFrame) -> DataFrame:
    """Incidents per victim age group."""
    return _count(star, ["age_group"])


def sex_breakdown(star: DataFrame) -> DataFrame:
    """Incidents per victim sex label."""
    return _count(star, ["sex_desc"])


def descent_breakdown(star: DataFrame) -> DataFrame:
    """Incidents per victim descent label."""
    return _count(star, ["descent_desc"])


def arrest_rate(star: DataFrame) -> DataFrame:
    """Overall arrest rate in % (unknown status counts as no arrest)."""
    arrested = F.coalesce(F.col("is_arrested"), F.lit(False))
    return star.agg(_total(star).alias(N), _total(star, arrested).alias("arrests")).select(
        N, "arrests", X.pct(F.col("arrests"), F.col(N)).alias("arrest_rate_pct"))


def arrest_by_status(star: DataFrame) -> DataFrame:
    """Juvenile vs adult arrests (status JA vs AA)."""
    return _count(star.filter(F.col("status").isin(C.ARREST_STATUSES)), ["status", "status_desc"])


def arrest_trend_area(star: DataFrame) -> DataFrame:
    """Arrest rate per area and month."""
    arrested = F.coalesce(F.col("is_arrested"), F.lit(False))
    g = star.groupBy("area", "area_name", "year_month").agg(
        _total(star).alias(N), _total(star, arrested).alias("arrests"))
    return g.withColumn("arrest_rate_pct", X.pct(F.col("arrests"), F.col(N)))


def calendar_usage(silver: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The date dimension with incidents occurred and reported per day.

    One pass over silver: each row contributes (occurred date, 1, 0) and
    (reported date, 0, 1); one grouping sums both roles; the dimension is
    left-joined so days without incidents show 0.
    """
    one, zero = F.lit(1), F.lit(0)
    roles = silver.select(F.explode(F.array(
        F.struct(F.col("date_occ").cast("date").alias("full_date"), one.alias("o"), zero.alias("r")),
        F.struct(F.col("date_rptd").cast("date").alias("full_date"), zero.alias("o"), one.alias("r")),
    )).alias("x")).select("x.*")
    per_day = roles.groupBy("full_date").agg(F.sum("o").alias("incidents_occurred"),
                                             F.sum("r").alias("incidents_reported"))
    out = dim_date.join(per_day, "full_date", "left")
    return out.withColumns({
        "incidents_occurred": F.coalesce("incidents_occurred", F.lit(0)).cast("bigint"),
        "incidents_reported": F.coalesce("incidents_reported", F.lit(0)).cast("bigint"),
    })


def time_usage(silver: DataFrame, dim_time: DataFrame) -> DataFrame:
    """The time dimension with incidents per minute of the day."""
    per = silver.groupBy("time_occ").agg(F.count(F.lit(1)).alias("incidents"))
    return dim_time.join(per, "time_occ", "left").withColumn("incidents", F.coalesce("incidents", F.lit(0)))


def layer_counts(bronze: DataFrame, silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts of the bronze, silver and fact layers."""
    return union_counts({"Bronze": bronze, "Silver": silver, "Fact": fact}, "layer", "rows")


# mart name -> (function, star roles it needs)
MARTS = {
    "yearly_yoy": (yearly_yoy, ["date_occurred"]),
    "month_heatmap": (month_heatmap, ["date_occurred"]),
    "quarterly_change": (quarterly_change, ["date_occurred"]),
    "density_grid": (density_grid, []),
    "top_areas": (top_areas, ["location"]),
    "region_area": (region_area, ["location"]),
    "day_of_week": (day_of_week, ["date_occurred"]),
    "hour_of_day": (hour_of_day, ["time"]),
    "type_by_period": (type_by_period, ["crime_type", "time"]),
    "top_weapons": (top_weapons, ["weapon"]),
    "weapon_category_share": (weapon_category_share, ["weapon"]),
    "weapon_trend": (weapon_trend, ["date_occurred"]),
    "age_groups": (age_groups, ["victim"]),
    "sex_breakdown": (sex_breakdown, ["victim"]),
    "descent_breakdown": (descent_breakdown, ["victim"]),
    "arrest_rate": (arrest_rate, []),
    "arrest_by_status": (arrest_by_status, ["status"]),
    "arrest_trend_area": (arrest_trend_area, ["location", "date_occurred"]),
}


def marts_all(star_for, cfg: C.Config = C.DEFAULT) -> dict[str, DataFrame]:
    """Every mart of B1-B18; ``star_for(roles)`` returns the star with the
    given dimension roles (e.g. ``Layers.star``).

    Each mart is its own narrow aggregation over the star with only the
    roles it needs, so it decodes only its own columns of the fact. (One
    ``GROUPING SETS`` pass over all marts was measured slower: 18 sets over
    25 grouping columns expand every fact row 18 times with wide keys.)
    """
    out = {}
    for name, (fn, roles) in MARTS.items():
        star = star_for(roles)
        out[name] = fn(star, cfg) if name == "density_grid" else fn(star)
    return out
