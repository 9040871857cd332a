"""Marts kept up by deltas (B1-B18): no rescan of the fact.

A mart is a grouping of the star. Its state is the same grouping one step
earlier, by the foreign keys (and flags) that the mart needs: a cube. Counts by
foreign key add up over runs and can be taken back, so

* a run of new facts adds its counts (``write_delta``),
* facts that are withdrawn or get another key are subtracted under their old
  keys and added under the new ones (``removed``; ``rekey_late`` hands over both),
* a member whose payload changes needs no delta: names are joined to the summed
  cube when the mart is read (``refreshed_mart``), by the mart's own function.

Every delta is one partition (run, change) of each cube, written anew when the
run is repeated, so counts are never added twice. The cubes of a delta are
written one after the other: a reader in between sees some of them ahead. A cube
has at most as many rows as combinations of its keys, per delta.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import marts as M
from ..operators.fact import star_view
from ..sources.tables import Layout, read_table, write_part

#: Cube -> the fact's columns it counts by.
CUBES: dict[str, list[str]] = {
    "day": ["date_occurred_key", "is_weapon_involved"],
    "location": ["location_key"],
    "location_day": ["location_key", "date_occurred_key", "is_arrested"],
    "type_time": ["crime_type_key", "time_occurred_key"],
    "weapon": ["weapon_key"],
    "victim": ["victim_demographic_key"],
    "status": ["status_key", "is_arrested"],
    "place": ["latitude", "longitude"],
}
#: Mart -> the cube it is read from.
MART_CUBES: dict[str, str] = {
    "yearly_yoy": "day", "month_heatmap": "day", "quarterly_change": "day", "day_of_week": "day", "weapon_trend": "day",
    "density_grid": "place", "top_areas": "location", "region_area": "location", "hour_of_day": "type_time",
    "type_by_period": "type_time", "top_weapons": "weapon", "weapon_category_share": "weapon", "age_groups": "victim",
    "sex_breakdown": "victim", "descent_breakdown": "victim", "arrest_rate": "status", "arrest_by_status": "status",
    "arrest_trend_area": "location_day",
}
#: What a delta of a run holds: its own facts, keys given later, facts withdrawn.
APPENDED, REKEYED, WITHDRAWN = 0, 1, 2


def _cube_path(layout: Layout, cube: str) -> str:
    return layout.path(f"mart_state_{cube}")


def write_delta(layout: Layout, run: int, added: DataFrame | None = None, removed: DataFrame | None = None,
                change: int = APPENDED) -> None:
    """Add the counts of ``added`` facts and subtract those of ``removed``.

    Each cube reads its own columns of the facts given and nothing else. Groups
    whose counts cancel out are not written."""
    needed = sorted({c for columns in CUBES.values() for c in columns})
    sides = [df.select(*needed, F.lit(sign).cast("bigint").alias(M.WEIGHT))
             for df, sign in ((added, 1), (removed, -1)) if df is not None]
    if not sides:
        raise ValueError("a delta needs facts that were added or removed")
    signed = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    for cube, columns in CUBES.items():
        counts = signed.groupBy(*columns).agg(F.sum(M.WEIGHT).alias(M.WEIGHT)).filter(F.col(M.WEIGHT) != 0)
        write_part(counts, _cube_path(layout, cube), run=run, change=change)


def rekeyed_delta(layout: Layout, run: int) -> Callable[[DataFrame, DataFrame], None]:
    """For ``rekey_late(on_change=...)``: the delta of the facts it gives keys to."""
    return lambda removed, added: write_delta(layout, run, added, removed, REKEYED)


def cube_state(spark: SparkSession, layout: Layout, cube: str) -> DataFrame:
    """A cube's counts over all deltas."""
    return (read_table(spark, _cube_path(layout, cube)).groupBy(*CUBES[cube])
            .agg(F.sum(M.WEIGHT).alias(M.WEIGHT)).filter(F.col(M.WEIGHT) != 0))


def refreshed_mart(spark: SparkSession, layout: Layout, name: str, dims: Mapping[str, DataFrame],
                   cfg: C.Config = C.DEFAULT, sizes: Mapping[str, int] | None = None) -> DataFrame:
    """The mart ``name`` from its cube; equal to the mart over the whole fact."""
    fn, roles = M.MARTS[name]
    star = star_view(cube_state(spark, layout, MART_CUBES[name]), dims, roles, cfg, sizes)
    return fn(star, cfg) if name == "density_grid" else fn(star)
