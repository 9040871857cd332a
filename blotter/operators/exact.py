"""Exact results with bounded memory: quantiles (A5), heavy groups (T2), dense
keys (G1, Q7) and a grid of several levels (B4)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize, read_table, table_exists, write_part

#: Bins of a histogram, and values of one bin that a task may sort.
BINS = 4_096
SORTED = 100_000


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], bins: int = BINS, most: int = SORTED) -> DataFrame:
    """A5: (prob, value): interpolated quantiles of the non-null, non-NaN values.

    Histograms are refined until the bin that holds a wanted rank has at most
    ``most`` values or just one; only such a bin is sorted. So no task holds a
    map of all values, whatever the column. A pass refines the bins of all ranks
    at once and returns at most ``bins`` counts for each to the driver. No values
    give NULLs."""
    spark = df.sparkSession
    v = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    n, low, high = v.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return spark.createDataFrame([(float(p), None) for p in probs], "prob double, value double")
    ranks = sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))})
    # (lowest and highest value, values before, values in it) -> ranks in it.
    open_, value = {(low, high, 0, n): ranks}, {}
    while open_:
        small = {b: r for b, r in open_.items() if b[0] == b[1] or b[3] <= most}
        value |= _from_sorted(v, {b: r for b, r in small.items() if b[0] < b[1]})
        value |= {r: b[0] for b, rs in small.items() if b[0] == b[1] for r in rs}
        open_ = _refined(v, {b: r for b, r in open_.items() if b not in small}, bins)
    out = []
    for p in probs:
        at = p * (n - 1)
        a, b = value[math.floor(at)], value[math.ceil(at)]
        out.append((float(p), a if a == b else a + (b - a) * (at - math.floor(at))))
    return spark.createDataFrame(out, "prob double, value double")


def _number(v: Column, ranges: Sequence[tuple]) -> Column:
    """Which of the disjoint ranges holds v, else NULL."""
    out = F.lit(None).cast("int")
    for i, b in enumerate(ranges):
        out = F.when((v >= b[0]) & (v <= b[1]), i).otherwise(out)
    return out


def _from_sorted(v: DataFrame, ranges: dict[tuple, list[int]]) -> dict[int, float]:
    if not ranges:
        return {}
    keys = list(ranges)
    held = (v.withColumn("i", _number(F.col("v"), keys)).filter("i is not null")
            .groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("s")))
    wanted = F.array(*[F.array(*[F.lit(r - b[2]) for r in ranges[b]]) for b in keys])
    rows = held.select("i", F.transform(F.get(wanted, F.col("i")), lambda k: F.get("s", k)).alias("x")).collect()
    return {rank: x for r in rows for rank, x in zip(ranges[keys[r.i]], r.x)}


def _refined(v: DataFrame, ranges: dict[tuple, list[int]], bins: int) -> dict[tuple, list[int]]:
    if not ranges:
        return {}
    keys = list(ranges)
    low, width = (F.array(*[F.lit(x) for x in xs]) for xs in ([b[0] for b in keys], [b[1] - b[0] for b in keys]))
    part = (F.col("v") - F.get(low, F.col("i"))) / F.get(width, F.col("i"))
    counts = (v.withColumn("i", _number(F.col("v"), keys)).filter("i is not null")
              .groupBy("i", F.least(F.floor(part * bins), F.lit(bins - 1)).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("i", "bin").collect())
    out: dict[tuple, list[int]] = {}
    before = {i: b[2] for i, b in enumerate(keys)}
    for r in counts:
        mine = [k for k in ranges[keys[r.i]] if before[r.i] <= k < before[r.i] + r.n]
        if mine:
            out[(r.low, r.high, before[r.i], r.n)] = mine
        before[r.i] += r.n
    return out


def proven_top_k(df: DataFrame, key: str, k: int, buckets: int = 1 << 16, tracked: int = 4_096) -> DataFrame:
    """The ``k`` most frequent non-null values of ``key`` (key, count), ties by
    the smaller value, without counting every value.

    A sketch proposes candidates. One pass counts them exactly, and all other
    rows by a hash bucket: no other value can have more rows than its bucket. The
    buckets that reach the k-th candidate's count, none where the keys are skewed,
    are then counted in full. The result is that of a full count on any data."""
    rows = df.select(F.col(key).alias("key")).filter(F.col("key").isNotNull())
    drawn = rows.agg(F.expr(f"approx_top_k(key, {min(2 * k, tracked)}, {tracked})").alias("t")).select(F.explode("t.item").alias("key")).distinct()
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")
    # At most ``tracked`` candidates.
    listed = F.broadcast(drawn.withColumn("_drawn", F.lit(True)))
    counted = (rows.join(listed, "key", "left")
               .groupBy(F.when(F.col("_drawn"), F.col("key")).alias("key"), F.when(F.col("_drawn").isNull(), bucket).alias("bucket"))
               .agg(F.count(F.lit(1)).alias("count")).persist())
    sure = counted.filter("bucket is null").select("key", "count")
    top = [r["count"] for r in sure.orderBy(F.desc("count")).limit(k).collect()]
    least = top[-1] if len(top) == k else 1
    # At most ``buckets`` numbers.
    full = [r.bucket for r in counted.filter((F.col("bucket").isNotNull()) & (F.col("count") >= least)).select("bucket").collect()]
    counted.unpersist()
    found = sure
    if full:
        again = F.broadcast(df.sparkSession.createDataFrame([(b,) for b in full], "bucket int"))
        rest = (rows.withColumn("bucket", bucket).join(again, "bucket", "left_semi").join(listed, "key", "left_anti")
                .groupBy("key").agg(F.count(F.lit(1)).alias("count")))
        found = sure.unionByName(rest)
    return found.orderBy(F.desc("count"), "key").limit(k)


def register_keys(members: DataFrame, natural: Sequence[str], path: str, run: int) -> DataFrame:
    """G1: the registry (natural, key) after ``run``: dense keys from 0 on that never
    collide and stay over runs.

    New members are range-partitioned and sorted; a member's key is the number of
    keys so far, plus the members of the partitions before its own, plus its place
    there. Only the counts of partitions are added up in one place."""
    spark, columns = members.sparkSession, list(natural)
    new = members.select(*columns).distinct()
    base = 0
    if table_exists(spark, path):
        known = read_table(spark, path).filter(F.col("run") != run)
        base = known.count()
        same = F.lit(True)
        for c in columns:
            same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"k.{c}"))
        new = new.alias("n").join(known.select(*columns).alias("k"), same, "left_anti").select(*columns)
    place = F.monotonically_increasing_id()
    placed = new.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = placed.select(*columns, F.shiftright(place, 33).alias("_part"), place.bitwiseAND((1 << 33) - 1).alias("_at"))
    staging = f"{path}_staging/run={run}"
    materialize(placed, staging)
    placed = read_table(spark, staging)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    keyed = placed.join(F.broadcast(sizes.select("_part", before.alias("_before"))), "_part")
    write_part(keyed.select(*columns, (F.lit(base) + F.col("_before") + F.col("_at")).cast("long").alias("key")), path, run=run)
    return read_table(spark, path).select(*columns, "key")


#: Cells per axis at the finest level are 2 to this power.
LEVELS = 12


def zorder_cell(lat: Column, lon: Column, levels: int = LEVELS) -> Column:
    """The cell of a point: the bits of its row and column by turns, so that the
    number without its last 2 j bits is that of the cell j levels up. Coordinates
    are taken as whole millionths of a degree."""
    def cell(x: Column, span: int) -> Column:
        scaled = F.round((x + span / 2) * 1_000_000).cast("long") * (1 << levels)
        inside = (scaled - F.pmod(scaled, F.lit(span * 1_000_000))) / (span * 1_000_000)
        return F.least(F.greatest(inside.cast("long"), F.lit(0)), F.lit((1 << levels) - 1)).cast("long")

    row, column = cell(lat, 180), cell(lon, 360)
    out = F.lit(0).cast("long")
    for b in range(levels):
        out = out + F.shiftleft(F.shiftright(row, b).bitwiseAND(1), 2 * b + 1) + F.shiftleft(F.shiftright(column, b).bitwiseAND(1), 2 * b)
    return out


def grid_levels(df: DataFrame, levels: Sequence[int], lat: str = "latitude", lon: str = "longitude", finest: int = LEVELS) -> DataFrame:
    """(level, cell, incidents) for each of ``levels`` (0: the whole globe).

    The rows are grouped once, by the finest cell; coarser levels add up those
    counts. Rows without coordinates are skipped."""
    cells = (df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())
             .groupBy(zorder_cell(F.col(lat), F.col(lon), finest).alias("cell")).agg(F.count(F.lit(1)).alias("n")))
    up = F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.shiftright("cell", 2 * (finest - x)).alias("cell")) for x in levels]))
    return (cells.select(up.alias("c"), "n").groupBy(F.col("c.level").alias("level"), F.col("c.cell").alias("cell"))
            .agg(F.sum("n").alias("incidents")))
