"""Facts and members that do not arrive together.

* ``append_facts`` writes a run's facts, partitioned by month and run, and
  lists the rows whose foreign key is NULL although their natural key is
  known: their member has not arrived yet.
* ``rekey_late`` takes the members that arrived since. Only listed rows are
  looked up, only in the new members, and only the partitions of rows that
  found one are written again.
* ``settle_members`` keeps, per natural key, the smallest payload seen so far.
  The minimum is associative, so any split of the rows into runs, in any order,
  ends at the batch dimension. A run appends a version that holds just the
  members it adds or improves.

Every write replaces whole partitions of its own run or of staged rows, so a
run that is repeated after a failure leaves the same tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import dims as D
from ..operators.fact import FACT_COLUMNS, FOREIGN_KEYS, attach_foreign_keys, fact_columns
from ..sources.tables import Layout, materialize, overwrite_partitions, read_table, table_exists, write_part

FACT = "fact_maintained"
PENDING = "fact_pending"
#: Silver columns by which foreign keys are looked up (and the row is known again).
NATURAL = ["dr_no", "date_occ", "date_rptd", "time_occ", "area", "rpt_dist_no", "crm_cd", "vict_age_clean", "vict_sex",
           "vict_descent", "premis_cd", "weapon_used_cd", "status"]
#: Columns that must be known for a NULL key to wait for a member. Victims and
#: weapons have members for missing values too, so theirs always wait.
AWAITED = {
    "date_occurred_key": ["date_occ"], "date_reported_key": ["date_rptd"], "time_occurred_key": ["time_occ"],
    "location_key": ["area", "rpt_dist_no"], "crime_type_key": ["crm_cd"], "victim_demographic_key": [],
    "premise_key": ["premis_cd"], "weapon_key": [], "status_key": ["status"],
}
_PLACE = ["row_hash", "month_occurred", "run"]


def _waits() -> Column:
    """Whether any foreign key of the row waits for a member."""
    out = F.lit(False)
    for key, known in AWAITED.items():
        one = F.col(key).isNull()
        for c in known:
            one = one & F.col(c).isNotNull()
        out = out | one
    return out


def _staged(df: DataFrame, layout: Layout, name: str) -> DataFrame:
    path = layout.path(f"_staging/{name}-{uuid.uuid4().hex}")
    materialize(df, path)
    return read_table(df.sparkSession, path)


def _row_hash() -> Column:
    """md5 of the natural columns, each with its length in front, so that different
    rows never spell the same text."""
    text = [F.col(c).cast("string") for c in NATURAL]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))


def append_facts(silver: DataFrame, dims: Mapping[str, DataFrame], layout: Layout, run: int,
                 cfg: C.Config = C.DEFAULT, ts: Column | None = None, sizes: Mapping[str, int] | None = None) -> None:
    """Write the facts of a run and the list of those that wait for a member."""
    month = F.coalesce(F.year("date_occ") * 100 + F.month("date_occ"), F.lit(0))
    keyed = (attach_foreign_keys(silver, dims, cfg, sizes)
             .withColumns({"row_hash": _row_hash(), "month_occurred": month, "run": F.lit(run)}))
    overwrite_partitions(keyed.select(*fact_columns(cfg, ts), *_PLACE), layout.path(FACT), ["month_occurred", "run"])
    waiting = keyed.filter(_waits()).select(*NATURAL, *FOREIGN_KEYS, F.lit(True).alias("waits"), *_PLACE)
    write_part(waiting.drop("run"), layout.path(PENDING), run=run)


def maintained_fact(spark: SparkSession, layout: Layout) -> DataFrame:
    """The fact's columns of all runs."""
    return read_table(spark, layout.path(FACT)).select(*FACT_COLUMNS)


def rekey_late(spark: SparkSession, layout: Layout, members: Mapping[str, DataFrame],
               cfg: C.Config = C.DEFAULT,
               on_change: Callable[[DataFrame, DataFrame], None] | None = None) -> dict[str, int]:
    """Give the waiting facts the keys of ``members`` (dimension -> members that
    are new since). Returns the rows that got a key, the partitions written again
    and the rows that still wait.

    ``on_change`` gets the rows that found a key, with the keys they had and with
    those they have now, before anything is written again. Both come from the
    list, so a call repeated after a failure hands over the same rows.

    The list of touched partitions (month, run) passes the driver; rows don't."""
    path = layout.path(PENDING)
    if not table_exists(spark, path):
        return {"rows": 0, "partitions": 0, "waiting": 0}
    pending = read_table(spark, path).filter("waits")
    known = {k: f"_had_{k}" for k in FOREIGN_KEYS}
    looked = attach_foreign_keys(pending.withColumnsRenamed(known), members, cfg)
    given = [k for k in FOREIGN_KEYS if k in looked.columns]
    found = F.lit(False)
    for k in given:
        found = found | (F.col(known[k]).isNull() & F.col(k).isNotNull())
    keys = [F.coalesce(F.col(known[k]), F.col(k)).alias(k) if k in given else F.col(known[k]).alias(k) for k in FOREIGN_KEYS]
    # Rows with equal natural keys get equal foreign keys: one is enough.
    fixed = _staged(looked.filter(found).select(*_PLACE, *keys, *known.values()).dropDuplicates(_PLACE), layout, "keys")
    parts = sorted((r.month_occurred, r.run) for r in fixed.select("month_occurred", "run").distinct().collect())
    rows = 0
    if parts:
        months, runs = sorted({m for m, _ in parts}), sorted({r for _, r in parts})
        new = fixed.select(*_PLACE, *[F.col(k).alias(f"_new_{k}") for k in FOREIGN_KEYS], *known.values(), F.lit(True).alias("_found"))
        now = {k: F.coalesce(F.col(k), F.col(f"_new_{k}")) for k in FOREIGN_KEYS}

        def repaired(df: DataFrame) -> DataFrame:
            return df.join(new, _PLACE, "left").withColumns(now).select(*df.columns)

        only = spark.createDataFrame(parts, "month_occurred int, run int")
        fact = read_table(spark, layout.path(FACT)).filter(F.col("month_occurred").isin(months) & F.col("run").isin(runs))
        # The rows meet their keys once; what follows reads the staged rows.
        columns = fact.columns
        met = _staged(fact.join(F.broadcast(only), ["month_occurred", "run"], "left_semi").join(new, _PLACE, "left"), layout, "fact")
        changed = met.filter("_found")
        rows = changed.count()
        if on_change:
            had = changed.drop(*FOREIGN_KEYS).withColumnsRenamed({v: k for k, v in known.items()})
            has = changed.drop(*FOREIGN_KEYS).withColumnsRenamed({f"_new_{k}": k for k in FOREIGN_KEYS})
            on_change(had.select(*FACT_COLUMNS), has.select(*FACT_COLUMNS))
        overwrite_partitions(met.withColumns(now).select(*columns), layout.path(FACT), ["month_occurred", "run"])
        listed = read_table(spark, path).filter(F.col("run").isin(runs))
        listed = _staged(repaired(listed).withColumn("waits", _waits()), layout, "pending")
        overwrite_partitions(listed, path, ["run"])
    return {"rows": rows, "partitions": len(parts), "waiting": read_table(spark, path).filter("waits").count()}


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def new_members(members: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """The rows of ``members`` whose natural key ``known`` does not have."""
    natural = D.NATURAL_KEYS[name][1]
    return members.alias("m").join(known.select(*natural).alias("k"), _same("m", "k", natural), "left_anti")


def settle_members(silver: DataFrame, name: str, layout: Layout, version: int) -> None:
    """Add a run's members of dimension ``name`` as a version: those that are
    new, and those whose payload is smaller than the one so far."""
    keys, payload = D.DIM_COLUMNS[name]
    columns, path = [*keys, *payload], layout.path(f"{name}_members")
    new = D.dedup(silver, keys, payload)
    if table_exists(silver.sparkSession, path):
        seen = read_table(silver.sparkSession, path).filter(F.col("version") != version).select(*columns)
        touched = seen.alias("s").join(new.select(*keys).alias("n"), _same("s", "n", keys), "left_semi")
        so_far = D.dedup(touched, keys, payload)
        best = D.dedup(so_far.unionByName(new.select(*columns)), keys, payload)
        new = best.alias("b").join(so_far.alias("o"), _same("b", "o", columns), "left_anti")
    # Staged: the version may be written anew after a failure.
    write_part(_staged(new.select(*columns), layout, f"{name}_members"), path, version=version)


def settled_dimension(spark: SparkSession, layout: Layout, name: str, cfg: C.Config = C.DEFAULT,
                      ts: Column | None = None) -> DataFrame:
    """Dimension ``name`` over all versions of its members."""
    return D.DATA_DIMS[name](read_table(spark, layout.path(f"{name}_members")), cfg, ts)
