"""Operator 11: hard negatives by Kronecker-packed inner products.

Vectors are rows of integers. Several candidates go into one wide integer per
component: each one's component, biased to be non-negative, has a field of its
own, wide enough for a whole inner product. One multiplication per anchor
component and a sum then give the inner products of all packed candidates at
once; the fields are unpacked and the biases taken back, so scores are exact.
The wide integers are doubles, which hold integers below 2^53; where a single
field needs more, they are Python integers of any width.

Two passes go over blocks of ``CHUNK`` anchors by ``CHUNK`` rows, dealt by hash,
so that no label and no anchor stays in one task and no pair is emitted. The
first pass meets anchors with rows of their label: each block hands on the
first positives of its anchors, of which Spark ranks the first ones overall.
The second meets anchors with all rows: each block hands on, per positive, the
first negatives inside the window of scores that the positive allows.

Defined cases: rows without id or label, and vectors that are null or hold null
or non-finite components take no part; rows that are equal in id, label and
vector are one; rows that share an id otherwise count as rows of their own;
vectors of different length do not meet; empty vectors have the score 0. A
component beyond a long holds the nearest long, as does a score. Ties go to
the smaller id. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, table, whole

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
CHUNK = 4_096
#: Anchors whose scores with a whole chunk are in memory at once.
SLICE = 256
#: Candidates in one wide integer where doubles are too narrow.
WIDE = 32
_EXACT = 53
_LONG = (1 << 63) - 1


def finite(embedding: str = "embedding") -> Column:
    ok = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return F.coalesce(ok, F.lit(False))


def most(v: np.ndarray) -> int:
    return max(abs(int(v.min())), abs(int(v.max()))) if v.size else 0


def pack(c: np.ndarray, width: int, fields: int, kind: type) -> np.ndarray:
    """Non-negative rows ``c``, ``fields`` of them in each wide integer per component."""
    full = np.zeros((-(-len(c) // fields) * fields, c.shape[1]), dtype=c.dtype)
    full[:len(c)] = c
    split = full.reshape(len(full) // fields, fields, c.shape[1])
    out = np.zeros((len(split), c.shape[1]), dtype=kind)
    for j in range(fields):
        out += split[:, j].astype(kind) * (1 << width * j)
    return out


class Packed:
    """Candidates packed for anchors whose components lie within ``low`` .. ``high``."""

    def __init__(self, c: np.ndarray, low: int, high: int):
        d, self.n = c.shape[1], len(c)
        self.low_a, self.low_c = low, int(c.min()) if c.size else 0
        top = d * (high - low) * ((int(c.max()) if c.size else 0) - self.low_c)
        self.width = max(1, top.bit_length())
        narrow = self.width <= _EXACT and d * max(abs(low), abs(high), 1) * max(most(c), 1) < 1 << 61
        self.kind = float if narrow else object
        if not narrow:
            c = c.astype(object)
        self.fields = _EXACT // self.width if narrow else WIDE
        self.sum_c = c.sum(axis=1)
        self.d = d
        self.wide = pack(c - self.low_c, self.width, self.fields, self.kind).T

    def scores(self, a: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows ``a`` with the candidates."""
        a = a if self.kind is float else a.astype(object)
        product = (a - self.low_a).astype(self.kind) @ self.wide
        rest = product.astype(np.int64) if self.kind is float else product
        out = np.empty((*rest.shape, self.fields), dtype=rest.dtype)
        mask = (1 << self.width) - 1
        for j in range(self.fields):
            out[:, :, j] = (rest >> (self.width * j)) & mask
        flat = out.reshape(len(a), rest.shape[1] * self.fields)[:, :self.n]
        # (a - la)(c - lc) summed is ac - lc a - la c + d la lc.
        return flat + self.low_c * a.sum(axis=1)[:, None] + self.low_a * self.sum_c[None, :] - self.d * self.low_a * self.low_c


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.int64)


def _nothing(s: np.ndarray) -> int:
    return -(1 << 62) if s.dtype != object else -(1 << 200)


def _taken(s: np.ndarray, count: int):
    """(rows, columns, scores) of the ``count`` highest entries of each row of
    ``s``, which it uses up; equal ones from the left."""
    least, rows = _nothing(s), np.arange(len(s))
    for _ in range(min(count, s.shape[1])):
        at = s.argmax(axis=1)
        best = s[rows, at]
        some = np.asarray(best > least, dtype=bool)
        if not some.any():
            return
        yield rows[some], at[some], best[some]
        s[rows, at] = least


def _longs(x: np.ndarray) -> np.ndarray:
    return x if x.dtype != object else np.array([max(-_LONG - 1, min(_LONG, int(v))) for v in x], dtype=np.int64)


def _slices(left: pd.DataFrame, right: pd.DataFrame):
    """(anchors of a slice, their scores) with ``right`` as the columns."""
    a, c = _matrix(left.v), _matrix(right.v)
    packed = Packed(c, int(a.min()) if a.size else 0, int(a.max()) if a.size else 0)
    for at in range(0, len(a), SLICE):
        yield left.iloc[at:at + SLICE], packed.scores(a[at:at + SLICE])


def best_positives(left: pd.DataFrame, right: pd.DataFrame, count: int) -> pd.DataFrame:
    right = right.sort_values(["vec_id", "row"], kind="stable")
    ids, row, out = right.vec_id.to_numpy(), right.row.to_numpy(), []
    if len(left) and len(right):
        for part, s in _slices(left, right):
            s[part.row.to_numpy()[:, None] == row[None, :]] = _nothing(s)
            for i, j, best in _taken(s, count):
                out.append(pd.DataFrame({"row": part.row.to_numpy()[i], "anchor_id": part.vec_id.to_numpy()[i],
                                         "positive_id": ids[j], "positive_row": row[j], "positive_score": _longs(best)}))
    return pd.concat(out) if out else pd.DataFrame(columns=["row", "anchor_id", "positive_id", "positive_row", "positive_score"])


def best_negatives(left: pd.DataFrame, right: pd.DataFrame, count: int, low: int, high: int) -> pd.DataFrame:
    """Per anchor and score of one of its positives, the first negatives in the window."""
    right = right.sort_values(["vec_id", "row"], kind="stable")
    ids, label, out = right.vec_id.to_numpy(), right.label.to_numpy(), []
    if len(left) and len(right):
        for part, s in _slices(left, right):
            none = _nothing(s)
            s[part.label.to_numpy()[:, None] == label[None, :]] = none
            wanted = [sorted(set(map(int, w))) for w in part.wanted]
            for k in range(max(map(len, wanted))):
                own = np.flatnonzero([len(w) > k for w in wanted])
                p = [wanted[i][k] for i in own]
                top = np.array([high * x // 100 for x in p], dtype=s.dtype)[:, None]
                end = np.array([-(-low * x // 100) for x in p], dtype=s.dtype)[:, None]
                mine = s[own]
                mine = np.where((mine <= top) & (mine >= end), mine, none)
                for i, j, best in _taken(mine, count):
                    out.append(pd.DataFrame({"row": part.row.to_numpy()[own[i]], "positive_score": np.array(p, dtype=np.int64)[i],
                                             "negative_id": ids[j], "negative_row": right.row.to_numpy()[j],
                                             "negative_score": _longs(best)}))
    return pd.concat(out) if out else pd.DataFrame(columns=["row", "positive_score", "negative_id", "negative_row", "negative_score"])


def _first(df: DataFrame, by: list[str], order: list, count: int, rank: str = "_rank") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= count)


def _dealt(rows: DataFrame, anchors: DataFrame, keys: list[str], chunk: int) -> tuple:
    """Anchors and rows of the same ``keys`` in blocks (keys, a, b), grouped for a cogroup."""
    def cuts(n: str) -> Column:
        return F.ceil(F.col(n) / chunk).cast("int")

    def part(n: str) -> Column:
        return F.pmod(F.xxhash64("row"), cuts(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), cuts(n) - 1))

    size = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
            .join(anchors.groupBy(*keys).agg(F.count(F.lit(1)).alias("_anchors")), keys))
    left = anchors.join(size, keys).withColumn("a", part("_anchors")).withColumn("b", every("_rows"))
    right = rows.join(size, keys).withColumn("b", part("_rows")).withColumn("a", every("_anchors"))
    by = [*keys, "a", "b"]
    return (left.drop("_rows", "_anchors").groupBy(*by), right.drop("_rows", "_anchors").groupBy(*by))


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, chunk: int = CHUNK) -> DataFrame:
    """Triples (anchor, positive, negative) of ``vectors`` (vec_id long, label,
    anchor boolean, v array<long>): see the module's text."""
    rows = stored(vectors.filter("vec_id is not null and label is not null and v is not null")
                  .select("vec_id", "label", F.coalesce("anchor", F.lit(False)).alias("anchor"), "v").distinct()
                  .withColumn("d", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    kept = rows.drop("anchor")
    anchors = rows.filter("anchor").select(*[F.col(c).alias(c) for c in kept.columns])

    def first(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return best_positives(left, right, positives)

    a, b = _dealt(kept, anchors, ["d", "label"], chunk)
    near = a.cogroup(b).applyInPandas(first, "row long, anchor_id long, positive_id long, positive_row long, positive_score long")
    near = stored(_first(near, ["row"], [F.desc("positive_score"), "positive_id", "positive_row"], positives).drop("_rank"),
                  "negatives-positives")

    def second(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return best_negatives(left, right, negatives, low, high)

    # At most ``positives`` scores per anchor.
    wanted = near.filter("positive_score >= 0").groupBy("row").agg(F.collect_set("positive_score").alias("wanted"))
    a, b = _dealt(kept, anchors.join(wanted, "row"), ["d"], chunk)
    far = a.cogroup(b).applyInPandas(second, "row long, positive_score long, negative_id long, negative_row long, negative_score long")
    far = _first(far, ["row", "positive_score"], [F.desc("negative_score"), "negative_id", "negative_row"], negatives, "rank")
    return (near.join(far, ["row", "positive_score"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def op11_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").filter(finite())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", label.alias("label"), (F.col("vec_id") % 50 == 0).alias("anchor"),
                                      whole("embedding").alias("v")))


ORACLE_SQL = f"""
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT *, row_number() OVER (ORDER BY vec_id, label, e) AS rn FROM v),
s AS MATERIALIZED (SELECT a.rn, a.vec_id AS anchor_id, b.rn AS other, b.vec_id AS other_id, a.label = b.label AS same,
    CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.rn <> b.rn AND len(a.e) = len(b.e)),
p AS (SELECT rn, anchor_id, other AS positive, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY rn ORDER BY score DESC, other_id, other) <= {POSITIVES}),
n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.rn, p.positive ORDER BY s.score DESC, s.other_id, s.other) AS rank
  FROM p JOIN s ON p.rn = s.rn AND NOT s.same
    AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {NEGATIVES}
"""
