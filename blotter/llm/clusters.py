"""Operator 12: exact k-means whose lower bounds are loosened by geometry.

Vectors are rows of integers, and so are the centroids (componentwise floor of
sum / count). Each vector carries a lower bound of its distance to all
centroids but its own. When centroids have moved, the members of cluster i lie
in the sphere around its old centroid that reaches its farthest member. Seen
from the old centroid j, in the plane of i, j and the way j moves, that sphere
lies within an angle of the way; the distance to j falls by no more than the
way's length times the cosine of the smallest angle (its full length only where
the sphere holds j or lies ahead). Members of i are loosened by the largest of
these over j, mostly much less than the largest drift. A vector stays without
a search while its exact distance to its moved centroid is below the bound; all
others are compared with every centroid, exactly.

Each round is one pass over the vectors: the assigned rows are written to the
shared folder and read once more for the sums (pre-aggregated per task). Only
centroids, counts and radii of the k clusters pass the driver.

Defined cases: vectors that are null, of another length or hold null or
non-finite components are left out; rows that repeat an id are vectors of their
own; rows without id belong to a cluster but start none; equal starting hashes
go by the components; with fewer than k vectors there are fewer centroids; an
empty cluster keeps its centroid; ties go to the smaller number. A component
beyond a long holds the nearest long, and so do distances and inertias. Other
columns are ignored; no vectors give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table, whole
from .negatives import finite, most

CLUSTERS = 40
ROUNDS = 5
LENGTH = 64
#: Prefix of the ids whose hashes choose the first centroids.
SEED = "2:"
#: Components below this keep all sums of squares of 64 of them exact in doubles.
_NARROW = 1 << 22
_SLACK = 1e-7
_LONG = (1 << 63) - 1


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows x to the rows c."""
    if max(most(x), most(c)) < _NARROW and x.shape[1] <= 128:
        x, c = x.astype(float), c.astype(float)
        return (x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    x, c = x.astype(object), c.astype(object)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]


def _own(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of x to the same row of c."""
    small = max(most(x), most(c)) < _NARROW
    diff = x.astype(float) - c.astype(float) if small else x.astype(object) - c.astype(object)
    return (diff * diff).sum(axis=1)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, the most by which the distance of a vector within
    ``radius`` of its old centroid to any other centroid can fall."""
    old, new = old.astype(float), new.astype(float)
    way = new - old
    drift = np.linalg.norm(way, axis=1)
    apart = old[:, None, :] - old[None, :, :]
    far = np.linalg.norm(apart, axis=2)
    with np.errstate(divide="ignore", invalid="ignore"):
        ahead = np.arccos(np.clip(np.einsum("ijd,jd->ij", apart, way) / (far * drift[None, :]), -1.0, 1.0))
        seen = np.arcsin(np.clip(radius[:, None] / far, 0.0, 1.0))
        fall = drift[None, :] * np.cos(np.maximum(0.0, ahead - seen - _SLACK))
    fall = np.where(far <= radius[:, None] * (1 + _SLACK), drift[None, :], fall)
    fall[:, drift == 0] = 0.0
    np.fill_diagonal(fall, -np.inf)
    return fall.max(axis=1)


def assign(x: np.ndarray, centroids: np.ndarray, cluster: np.ndarray | None = None, lower: np.ndarray | None = None):
    """(cluster, exact squared distance, lower bound of the distance to any other
    centroid, whether it was searched for) of each row of x."""
    n = len(x)
    if cluster is None:
        cluster, lower = np.zeros(n, dtype=np.int64), np.full(n, -np.inf)
    cluster, lower = cluster.copy(), lower.copy()
    own = _own(x, centroids[cluster])
    search = np.sqrt(own.astype(float)) * (1 + _SLACK) + _SLACK >= lower
    if search.any():
        d = squared(x[search], centroids)
        best = d.argmin(axis=1)
        rows = np.arange(len(d))
        own[search], cluster[search] = d[rows, best], best
        d = d.astype(float)
        d[rows, best] = np.inf
        lower[search] = np.sqrt(d.min(axis=1)) * (1 - _SLACK)
    return cluster, own, lower, search


def first_centroids(vectors: DataFrame, k: int, seed: str = SEED) -> np.ndarray:
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    drawn = vectors.filter("vec_id is not null").select("v", order.alias("h")).orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in drawn], dtype=np.int64)


def _round(vectors: DataFrame, centroids: np.ndarray, fall: np.ndarray | None) -> DataFrame:
    """Vectors with cluster, distance, lower bound and ``searched``; ``fall``:
    what to take from the bounds of each cluster's members."""
    length = centroids.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, length)
            if fall is None:
                cluster, own, lower, search = assign(x, centroids)
            else:
                before = b.column("cluster").to_numpy()
                cluster, own, lower, search = assign(x, centroids, before, b.column("lower").to_numpy() - fall[before])
            longs = own.astype(np.int64) if own.dtype != object else [min(int(d), _LONG) for d in own]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), v, pa.array(cluster, pa.int32()), pa.array(longs, pa.int64()),
                 pa.array(np.sqrt(own.astype(float))), pa.array(lower), pa.array(search)],
                ["vec_id", "v", "cluster", "distance", "reach", "lower", "searched"])

    return vectors.mapInArrow(work, "vec_id long, v array<long>, cluster int, distance long, reach double, "
                                    "lower double, searched boolean")


def _moved(assigned: DataFrame, centroids: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(new centroids, reach of each cluster around its old one)."""
    sums = [F.sum(F.get("v", F.lit(i)).cast(kind)).alias(f"s{i}") for i in range(centroids.shape[1])]
    rows = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("reach"), *sums).collect()
    new, reach = centroids.copy(), np.zeros(len(centroids))
    for r in rows:
        new[r.cluster] = [int(r[f"s{i}"]) // r.n for i in range(centroids.shape[1])]
        reach[r.cluster] = r.reach
    return new, reach


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, length: int = LENGTH,
                    seed: str = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vectors (vec_id, v array<long> of ``length``) with cluster, distance and
    ``searched`` of the last pass, final centroids)."""
    kept = stored(vectors.filter(F.size("v") == length).select("vec_id", "v"), "clusters-vectors")
    centroids, fall = first_centroids(kept, k, seed), None
    if not len(centroids):
        return _round(kept.limit(0), np.zeros((1, length), dtype=np.int64), None), centroids
    state = kept
    ends = kept.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    kind = "long" if max(-ends.low, ends.high) < _NARROW else "decimal(38,0)"
    for _ in range(rounds):
        state = stored(_round(state, centroids, fall), "clusters-round")
        new, reach = _moved(state, centroids, kind)
        fall = loosening(centroids, new, reach)
        centroids = new
    return stored(_round(state, centroids, fall), "clusters-last"), centroids


def _long_sum(column: str):
    total = F.sum(F.col(column).cast("decimal(38,0)"))
    return F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("long")


def op12_drift_clusters(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").filter(finite())
    found, centroids = cluster_vectors(rows.select("vec_id", whole("embedding").alias("v")))
    # At most CLUSTERS rows.
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(_long_sum("distance").alias("inertia")).collect()}
    number = range(max(len(centroids), 1))
    total = min(sum(inertia.values()), _LONG)
    named = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids] or [""]

    def of(values: list, kind: str):
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))

    return found.select("vec_id", "cluster", "distance", of([inertia.get(i, 0) for i in number], "long").alias("cluster_inertia"),
                        F.lit(total).cast("long").alias("inertia"), of(named, "string").alias("centroid_sha256"))


def _sql_round(i: int) -> str:
    """Assignment to the centroids c{i} and, from it, c{i+1}."""
    return f"""
a{i} AS MATERIALIZED (SELECT vec_id, rn, e, k, d FROM (SELECT v.vec_id, v.rn, v.e, c.k,
    list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e) AS d FROM v, c{i} c)
  QUALIFY row_number() OVER (PARTITION BY rn ORDER BY d, k) = 1),
s{i} AS (SELECT k, i, CAST(sum(e[i]) AS BIGINT) AS s, count(*) AS n FROM a{i}, range(1, {LENGTH + 1}) t(i) GROUP BY k, i),
n{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS e FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(n.e, c.e) AS e FROM c{i} c LEFT JOIN n{i} n ON c.k = n.k)"""


ORACLE_SQL = f"""
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rn, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE len(embedding) = {LENGTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e FROM
  (SELECT sha256('{SEED}' || vec_id) AS h, e FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT {CLUSTERS})),
{",".join(_sql_round(i) for i in range(ROUNDS + 1))},
f AS (SELECT vec_id, k, CAST(d AS BIGINT) AS distance FROM a{ROUNDS}),
h AS (SELECT k, sha256(array_to_string(list_transform(e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256 FROM c{ROUNDS})
SELECT f.vec_id, CAST(f.k AS INTEGER) AS cluster, f.distance,
  CAST(sum(f.distance) OVER (PARTITION BY f.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(f.distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM f JOIN h ON f.k = h.k
"""
