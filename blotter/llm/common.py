"""Shared pieces of the training-data operators.

Intermediate tables go to the shared folder the session names in
``spark.checkpoint.dir`` (``scratch``); lookups whose key may be hot are
salted (``salted_lookup``); links are resolved to classes by
``components``, which keeps every edge in Spark.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch where whole texts go to Python.
TEXT_BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the session's shared checkpoint folder.

    Only a local session without the setting gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="blotter-llm-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps read
    it with column pruning, and a lost executor loses nothing of it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` as column ``_row`` beside the columns an operator needs, so that its
    other columns may have any name; ``unpacked`` gives it back."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, *[F.col(c) for c in cols])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("_row.*")


def small_text_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by which whole texts reach Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_BATCH_ROWS))


def whole(embedding: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as a long; what is beyond a long holds the nearest one."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


#: Elements of a block of ``running``.
_RUN = 256


def running(values: Column, step: Callable[[Column, Column], Column], start: int = 0) -> Column:
    """For each element of an int array, what ``step`` (associative, ``start`` its
    neutral element) makes of those before it; one more entry holds all.

    Folded in blocks, so that a long array isn't copied for each element."""
    def fold(items: Column, value: Callable[[Column], Column]) -> Column:
        first = F.struct(F.lit(start).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(items, first, lambda acc, x: F.struct(
            step(acc["at"], value(x)).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    def joined(parts: Column) -> Column:
        all_of = fold(parts, lambda p: p["at"])
        each = F.zip_with(parts, all_of["out"], lambda p, o: F.transform(p["out"], lambda v: step(o, v)))
        return F.array_append(F.flatten(each), all_of["at"])

    def blocks(v: Column) -> Column:
        cuts = F.sequence(F.lit(0), F.floor(F.size(v) / _RUN).cast("int"))
        return F.transform(cuts, lambda b: fold(F.slice(v, b * _RUN + 1, _RUN), lambda x: x))

    return let(let(values, blocks), joined)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, regex: str, group: int = 0) -> Column:
    """Array of (start, end, before, value, part) of the leftmost non-overlapping
    matches: code points, the text since the match before, the match and its
    ``group``. The work is in proportion to text and matches; ``regex`` never
    matches nothing."""
    def placed(between: Column, whole: Column) -> Column:
        part = F.regexp_extract_all(text, F.lit(regex), F.lit(group)) if group else whole
        size = F.zip_with(between, whole, lambda b, w: F.length(b) + F.coalesce(F.length(w), F.lit(0)))
        each = let(running(size, lambda x, y: x + y), lambda at: F.arrays_zip(
            between.alias("before"), whole.alias("value"), part.alias("part"), at.alias("at")))
        found = F.filter(each, lambda x: x["value"].isNotNull())
        return F.transform(found, lambda x: F.struct(
            (x["at"] + F.length(x["before"])).alias("start"), (x["at"] + F.length(x["before"]) + F.length(x["value"])).alias("end"),
            x["before"].alias("before"), x["value"].alias("value"), x["part"].alias("part")))

    return let(F.split(text, regex, -1), lambda b: let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), lambda w: placed(b, w)))


def salted_lookup(left: DataFrame, right: DataFrame, keys: list[str], spread: Column,
                  how: str = "inner", salts: int = 8) -> DataFrame:
    """Join ``left`` to ``right`` (one row per key) when a key may be hot on the left.

    Left rows of a key go to ``salts`` places by a hash of ``spread`` (columns of
    the row itself, so that a repeated task deals alike); the right row is there
    in each. Both sides are then exchanged for this join alone, so Spark can
    also split what is still too large. Keys match null-safely."""
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    a = left.withColumn("_salt", salt)
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lookup(a, b, [*keys, "_salt"], how).drop("_salt")


def lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (one row per key), null-safely, for large ``right``
    sides, which are not repeated: both sides are exchanged for this join alone, so
    a hot key's left rows are split over tasks by the adaptive skew join."""
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    picked = [F.col(f"a.{c}") for c in left.columns] + [F.col(f"b.{c}") for c in right.columns if c not in keys]
    return left.alias("a").join(right.alias("b"), on, how).select(*picked)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u long, v long): rows (node, component).

    Large-star and small-star steps in turn: every node's neighbours are linked
    to the smallest one known until the edges are stars around the smallest
    node of each component. Minima are combined before the shuffle and a hot
    node's edges are split by the adaptive skew join, so no step holds a node's neighbours together."""
    e = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .filter("u <> v").distinct(), "links")
    for _ in range(rounds):
        if _stars(e):
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(lookup(both, low, ["u"]).filter("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup(large, low, ["u"])
        pair = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                 F.struct(F.col("u"), F.col("m").alias("v"))))
        e = stored(small.select(pair.alias("e")).select("e.*").filter("u <> v").distinct(), "links")
    raise RuntimeError("components did not settle")


def _stars(e: DataFrame) -> bool:
    """Whether every node is either the centre of its edges (as v) or has one edge (as u)."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("a"), F.lit(0).alias("b")),
                             F.struct(F.col("v").alias("x"), F.lit(0).alias("a"), F.lit(1).alias("b"))))
    held = e.select(ends.alias("e")).groupBy("e.x").agg(F.sum("e.a").alias("a"), F.max("e.b").alias("b"))
    return held.filter("a + b <> 1").isEmpty()
