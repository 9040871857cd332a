"""Operator 5: mixing sources to target weights by iterative proportional fitting (native).

Tokens are summed per cell (source, language, topic); the cell weights are
raked in turn to the three target marginals; a document is kept with its
cell's calibrated probability, decided by a hash of its id, so the same
document gets the same decision in every run. DataFrame functions only.

Targets are tempered shares: a category's target is its token share to the
power ``ALPHA``, normalised (1 keeps the mix, 0 makes categories equal), or an
explicit table (category, target). The expected number of tokens kept is
``KEEP`` of all. Cells are raked under the bound that no probability exceeds 1
(``bounded``): a category that has fewer tokens than its target asks for gives
all of them, and the others of its dimension share the rest as their targets
are. A category that misses its goal by more than ``TOLERANCE`` after all sweeps
(few and sparse cells may allow no better) is reported by a warning.

Defined cases: null source or language is a category of its own; a null text
has no token and topic ``prose``; a document without tokens gets its cell's
probability; without any token nothing is dropped; rows that repeat an id are
decided alike; a null id is decided by its text. ``sample`` passes all columns
through, whatever their names.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, salted_lookup, stored, table, unpacked

DIMENSIONS = ("source", "lang", "topic")
ALPHA = 0.7
KEEP = 0.6
#: Rakings of all three marginals.
SWEEPS = 12
#: A cell is full from this part of its tokens on, so that rounding decides nothing.
FULL = 1 - 1e-9
#: The largest miss of a category, as a part of all tokens, that isn't reported.
TOLERANCE = 1e-3
#: Cell, target and factor tables are broadcast up to this many rows (some 80
#: bytes each); beyond, they are joined by shuffles.
MAX_BROADCAST_ROWS = 50_000
SEED = "mix-1"


def topic(text: Column) -> Column:
    """Coarse topic by surface cues; the first that holds counts."""
    t = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(t, F.lit(" | ")), "listing").when(F.contains(t, F.lit("***")), "markup")
            .when(F.contains(t, F.lit("!!")), "promotion").when(F.contains(t, F.lit("@")), "contact")
            .otherwise("prose"))


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def uniform(docs: DataFrame, seed: str = SEED) -> Column:
    """A number in [0, 1) from the document id."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), name)), 1, 13), 16, 10).cast("double") / float(16 ** 13)


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """(dim, target): token shares to the power ``alpha``, which sum to 1."""
    share = cells.groupBy(dim).agg(F.pow(F.sum("n").cast("double"), alpha).alias("t"))
    total = share.agg(F.sum("t")).first()[0] or 1.0
    return share.select(dim, (F.col("t") / F.lit(float(total))).alias("target"))


def goals(cells: DataFrame, dim: str, target: DataFrame, keep: float = KEEP, cuts: int = 60) -> DataFrame:
    """(dim, goal): the tokens to keep of each category. None is asked for more
    than it has; what that leaves goes to the others as their targets are."""
    held = (cells.groupBy(dim).agg(F.sum("n").cast("double").alias("_have")).alias("h")
            .join(target.alias("t"), F.col(f"h.{dim}").eqNullSafe(F.col(f"t.{dim}")), "left")
            .select(F.col(f"h.{dim}").alias(dim), "_have", F.coalesce("target", F.lit(0.0)).alias("_share")))
    held = stored(held, f"mix-have-{dim}")
    total = held.agg(F.sum("_have")).first()[0] or 0.0
    scale, before = 0.0, -1
    for _ in range(cuts):
        full = (F.col("_share") > 0) & (F.lit(scale) * F.col("_share") >= F.col("_have"))
        number, given, rest = held.agg(F.sum(full.cast("long")), F.sum(F.when(full, F.col("_have")).otherwise(0.0)),
                                       F.sum(F.when(~full, F.col("_share")).otherwise(0.0))).first()
        if number == before or not rest:
            break
        before, scale = number, max(0.0, keep * total - given) / rest
    return held.select(dim, F.least("_have", F.lit(float(scale)) * F.col("_share")).alias("goal"))


def _missed(cells: DataFrame, want: dict[str, DataFrame]) -> float:
    """The most tokens by which a category with its goal in ``want`` misses it."""
    most = 0.0
    for dim, goal in want.items():
        given = cells.groupBy(dim).agg(F.sum(F.least(F.col("w"), F.col("n").cast("double"))).alias("_given")).alias("h")
        off = given.join(goal.alias("t"), F.col(f"h.{dim}").eqNullSafe(F.col(f"t.{dim}"))).agg(F.max(F.abs(F.col("goal") - F.col("_given"))))
        most = max(most, off.first()[0] or 0.0)
    return most


def bounded(cells: DataFrame, targets: dict[str, DataFrame], keep: float = KEEP, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` with ``p``: raked so that sum(p n) of each category meets its goal with p <= 1.

    ``w`` may pass n: min(n, w) counts, and a cell at its bound leaves to the
    others what it cannot give."""
    want = {d: stored(goals(cells, d, t, keep), f"mix-goal-{d}") for d, t in targets.items()}
    small = {d: t.count() <= MAX_BROADCAST_ROWS for d, t in want.items()}
    total = float(cells.agg(F.sum("n")).first()[0] or 0)
    if not total:
        return cells.withColumn("p", F.lit(1.0))
    out = cells.withColumn("w", F.col("n") * F.lit(float(keep)))
    for _ in range(sweeps):
        for dim, goal in want.items():
            full = F.col("w") >= F.col("n") * FULL
            had = out.groupBy(dim).agg(F.sum(F.when(full, F.col("n")).otherwise(0)).cast("double").alias("_full"),
                                       F.sum(F.when(full, 0.0).otherwise(F.col("w"))).alias("_free"))
            left, both = F.col("goal") - F.col("_full"), F.col("_full") + F.col("_free")
            factor = (had.alias("h").join((F.broadcast(goal) if small[dim] else goal).alias("t"), F.col(f"h.{dim}").eqNullSafe(F.col(f"t.{dim}")))
                      .select(F.col(f"h.{dim}").alias(dim),
                              F.when((left > 0) & (F.col("_free") > 0), left / F.col("_free"))
                              .when(F.col("goal") < both, F.col("goal") / both).otherwise(1.0).alias("_f")))
            factor = F.broadcast(factor) if small[dim] else factor
            out = (out.alias("c").join(factor.alias("f"), F.col(f"c.{dim}").eqNullSafe(F.col(f"f.{dim}")), "left")
                   .select(*[F.col(f"c.{c}") for c in cells.columns], (F.col("c.w") * F.coalesce(F.col("_f"), F.lit(0.0))).alias("w")))
        out = stored(out, "mix-sweep")
    missed = _missed(out, want) / total
    if missed > TOLERANCE:
        warnings.warn(f"a category is off its goal by {missed:.2g} of all tokens", stacklevel=2)
    return out.withColumn("p", F.when(F.col("n") > 0, F.least(F.lit(1.0), F.col("w") / F.col("n"))).otherwise(0.0))


def mix(docs: DataFrame, alpha: float = ALPHA, keep: float = KEEP, sweeps: int = SWEEPS,
        targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``docs`` with ``_tokens``, ``_topic``, ``_p`` and ``_kept`` for every row
    (in place of columns of these names)."""
    rows = docs.drop("_p", "_kept", "_source", "_lang", "_t").withColumn("_tokens", n_tokens(F.col("text"))).withColumn("_topic", topic(F.col("text")))
    cells = stored(rows.groupBy("source", "lang", F.col("_topic").alias("topic"))
                   .agg(F.sum("_tokens").alias("n")), "mix-cells")
    want = targets or {d: stored(tempered(cells, d, alpha), f"mix-{d}") for d in DIMENSIONS}
    p = stored(bounded(cells, want, keep, sweeps)
               .select(F.col("source").alias("_source"), F.col("lang").alias("_lang"),
                       F.col("topic").alias("_t"), F.col("p").alias("_p")), "mix-p")
    keyed = rows.withColumn("_source", F.col("source")).withColumn("_lang", F.col("lang")).withColumn("_t", F.col("_topic"))
    keys = ["_source", "_lang", "_t"]
    if p.count() <= MAX_BROADCAST_ROWS:
        on = None
        for k in keys:
            one = F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
            on = one if on is None else on & one
        out = keyed.alias("a").join(F.broadcast(p).alias("b"), on).select("a.*", "b._p")
    else:
        out = salted_lookup(keyed, p, keys, F.col("doc_id"))
    return out.drop(*keys).withColumn("_kept", uniform(docs) < F.col("_p"))


def sample(docs: DataFrame, **how) -> DataFrame:
    """The kept rows of ``docs`` with their own columns."""
    return unpacked(mix(packed(docs, "doc_id", "text", "source", "lang"), **how).filter("_kept"))


def op5_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mix(docs).select("doc_id", "source", "lang", F.col("_topic").alias("topic"),
                            F.col("_tokens").alias("n_tokens"), F.round("_p", 9).alias("probability"),
                            F.col("_kept").alias("kept"))


def _oracle() -> str:
    ctes = ["whole AS (SELECT sum(n) AS total FROM cells)"]
    for d in DIMENSIONS:
        # Filled up in the order of tokens per target: the scale at which the goals sum to what is kept.
        ctes.append(f"""
s_{d} AS (SELECT {d}, CAST(sum(n) AS DOUBLE) AS have, pow(CAST(sum(n) AS DOUBLE), {ALPHA}) AS t FROM cells GROUP BY {d}),
t_{d} AS (SELECT {d}, have, t / (SELECT sum(t) FROM s_{d}) AS target FROM s_{d}),
o_{d} AS (SELECT *, row_number() OVER (ORDER BY have / target, {d}) AS i FROM t_{d} WHERE target > 0),
r_{d} AS (SELECT o.*, ({KEEP} * (SELECT total FROM whole) - coalesce((SELECT sum(have) FROM o_{d} b WHERE b.i < o.i), 0))
    / (SELECT sum(target) FROM o_{d} b WHERE b.i >= o.i) AS scale FROM o_{d} o),
g_{d} AS MATERIALIZED (SELECT {d}, least(have, target * (SELECT scale FROM r_{d} WHERE scale < have / target ORDER BY i LIMIT 1)) AS goal FROM t_{d})""")
    last = "c0"
    ctes.append(f"c0 AS MATERIALIZED (SELECT *, n * CAST({KEEP} AS DOUBLE) AS w FROM cells)")
    k = 0
    for _ in range(SWEEPS):
        for d in DIMENSIONS:
            k += 1
            ctes.append(f"""
c{k} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.n, c.w * CASE WHEN g.goal > h.f AND h.free > 0 THEN (g.goal - h.f) / h.free
    WHEN g.goal < h.f + h.free THEN g.goal / (h.f + h.free) ELSE 1 END AS w
  FROM {last} c JOIN (SELECT {d}, CAST(sum(CASE WHEN w >= n * CAST({FULL!r} AS DOUBLE) THEN n ELSE 0 END) AS DOUBLE) AS f, sum(CASE WHEN w >= n * CAST({FULL!r} AS DOUBLE) THEN 0.0 ELSE w END) AS free
    FROM {last} GROUP BY {d}) h ON c.{d} IS NOT DISTINCT FROM h.{d} JOIN g_{d} g ON g.{d} IS NOT DISTINCT FROM c.{d})""")
            last = f"c{k}"
    return f"""
WITH d AS (SELECT doc_id, source, lang, CASE WHEN contains(text, ' | ') THEN 'listing' WHEN contains(text, '***') THEN 'markup'
    WHEN contains(text, '!!') THEN 'promotion' WHEN contains(text, '@') THEN 'contact' ELSE 'prose' END AS topic,
    CAST(coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS BIGINT) AS n_tokens,
    CAST(('0x' || substr(md5('{SEED}:' || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) / CAST({16 ** 13} AS DOUBLE) AS u
    FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS BIGINT) AS n FROM d GROUP BY ALL),
{", ".join(ctes)}
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(p, 9) AS probability, d.u < p AS kept
FROM d JOIN (SELECT *, CASE WHEN n > 0 THEN least(1.0, w / n) ELSE 0 END AS p FROM {last}) c
  ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang AND d.topic = c.topic
"""


ORACLE_SQL = _oracle()
