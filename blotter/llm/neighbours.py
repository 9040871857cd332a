"""Operator 3: exact near duplicates of embeddings by a metric range join.

Angles between vectors are a metric. Pivots (a farthest-first choice from a
bounded sample) partition the vectors by the nearest one. Each cell is written
once, in blocks of some ``CHUNK`` vectors and bundles of ``BUNDLE`` blocks, so a
cell of any size is spread over tasks. Bundles meet in pairs read from there: no
vector is repeated in a shuffle or on disk, whatever the number of pairs. Two
bundles, and two of their blocks, meet unless the triangle inequality keeps the
distances that their vectors have to some pivot more than the radius r apart. A
vector x only meets another block if d(x, its pivot p) <= d(x, own pivot) + 2r
and, for p and the first ``BOUND_PIVOTS`` pivots, d(x, q) is within r of the
range of that block.

Products are made in single precision with an error bound; whatever the bound
leaves open is decided in double precision. Where a few leading components
(of a basis of the sample) and the length of the rest bound nearly all products
below the threshold, only the pairs they leave open are multiplied out. No pair
of vectors is emitted: a task returns counts and a spanning forest.

Equal vectors are joined once, with their number as weight; rows find theirs by
a hash, and by the vector itself where vectors share one. Vectors that are
null, zero, or hold null or non-finite components link with nothing; vectors
of different length do not link. Rows that repeat an id count as vectors of
their own; a null id is never a component's id while another is there. Other
columns are ignored, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, lookup, stored, table

COSINE = 0.9
#: Vectors from which pivots are chosen, and the most pivots per vector length.
SAMPLE = 2_000
MAX_PIVOTS = 512
BOUND_PIVOTS = 16
CHUNK = 4_096
_SLACK = 1e-7
#: Blocks of a bundle, and the bytes of its numbers, at most.
BUNDLE = 8
BUNDLE_BYTES = 16 << 20
#: Share of open products up to which leading components are worth their while.
OPEN = 3e-4
#: Rows and columns of a product that is made at once.
TILE = 512
_BUNDLE = ("d int, node array<long>, m array<long>, wide int, raw binary, low array<double>, high array<double>, "
           "cell array<int>, size array<int>, lows array<double>, highs array<double>")


def valid(embedding: str = "embedding"):
    e = F.col(embedding)
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return F.coalesce(finite & F.exists(e, lambda v: v != 0), F.lit(False))


def _unit(rows) -> np.ndarray:
    x = np.asarray(rows, dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice of at most n of the unit vectors x."""
    chosen, far = [0], None
    while len(chosen) < min(n, len(x)):
        d = _angles(x, x[chosen[-1:]])[:, 0]
        far = d if far is None else np.minimum(far, d)
        if far.max() < 1e-6:
            break
        chosen.append(int(far.argmax()))
    return x[chosen]


def leading(x: np.ndarray, cosine: float) -> np.ndarray | None:
    """The fewest axes (columns) whose components bound nearly all products of the
    unit vectors x below ``cosine``; None if half of the components don't."""
    x = x[:1_000]
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    far = np.triu(x @ x.T < cosine, 1)
    for k in range(8, x.shape[1] // 2 + 1, 8):
        z = _short(x, axes[:, :k])
        if (far & (z @ z.T >= cosine)).sum() <= OPEN * far.sum():
            return axes[:, :k]
    return None


def _short(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Components along ``axes`` and the length of the rest: products of these are
    no smaller than those of the unit vectors x."""
    z = x @ axes
    return np.column_stack([z, np.sqrt(np.clip(1 - np.einsum("ij,ij->i", z, z), 0, None))])


def _by_length(batch: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, unit vectors) for each vector length in the batch."""
    sizes = batch.embedding.map(len).to_numpy()
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield int(d), at, _unit(np.stack(batch.embedding.to_numpy()[at]))


class Partition:
    """Pivots and, where they help, leading axes per vector length."""

    def __init__(self, pivots: dict[int, np.ndarray], axes: dict[int, np.ndarray | None], radius: float):
        self.pivots, self.axes, self.radius = pivots, axes, radius + _SLACK

    def products(self, d: int, x: np.ndarray) -> np.ndarray:
        """With each pivot; a length that the sample hasn't is one cell."""
        p = self.pivots.get(d)
        return np.zeros((len(x), 1)) if p is None else np.clip(x @ p.T, -1.0, 1.0)

    def home(self, d: int, x: np.ndarray) -> np.ndarray:
        """Own cell of each row."""
        return self.products(d, x).argmax(axis=1)


def partition(reps: DataFrame, cosine: float = COSINE, chunk: int = CHUNK) -> Partition:
    """Pivots and axes from a sample."""
    total = reps.count()
    drawn = [np.array(r.embedding, dtype=np.float64) for r in
             reps.orderBy(F.xxhash64("node")).limit(SAMPLE).select("embedding").collect()]
    n = int(np.clip(-(-total // chunk), 1, MAX_PIVOTS))
    of = {d: _unit([v for v in drawn if len(v) == d]) for d in sorted({len(v) for v in drawn})}
    return Partition({d: choose_pivots(x, n) for d, x in of.items()}, {d: leading(x, cosine) for d, x in of.items()},
                     float(np.arccos(cosine)))


def deal_out(sizes, part: Partition, chunk: int = CHUNK) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length the number of blocks and the first block of each cell, and the bundle
    of each block. Cells near the same one of the first pivots stand together."""
    dealt, bundle, cells = {}, -1, {}
    for r in sizes:
        cells.setdefault(r.d, []).append(r)
    for d in sorted(cells):
        p, most = part.pivots.get(d), max(1, min(BUNDLE * chunk, BUNDLE_BYTES // (8 * d)))
        homes = np.zeros(1 if p is None else len(p), np.int64)
        for r in cells[d]:
            homes[r.cell] = r.homes
        n = -(-homes // min(chunk, most))
        order = np.arange(len(n)) if p is None else np.argsort((p @ p[:BOUND_PIVOTS].T).argmax(axis=1), kind="stable")
        first, of, full = np.cumsum(n) - n, np.zeros(n.sum(), np.int64), most + 1
        for c in order:
            for k in range(n[c]):
                size = -(-homes[c] // n[c])
                if full + size > most:
                    bundle, full = bundle + 1, 0
                of[first[c] + k], full = bundle, full + size
        dealt[d] = n, first, of
    return dealt


def bundles(reps: DataFrame, part: Partition, chunk: int = CHUNK) -> DataFrame:
    """The vectors, each once, in blocks of a cell and bundles of blocks, stored with an id; with the
    least and largest distance that the vectors of a bundle, and of each block, have to each pivot."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, _, x in _by_length(b):
                cell, homes = np.unique(part.home(d, x), return_counts=True)
                out.append(pd.DataFrame({"d": d, "cell": cell, "homes": homes}))
            if out:
                yield pd.concat(out)

    sizes = (reps.select("embedding").mapInPandas(count, "d int, cell int, homes long")
             .groupBy("d", "cell").agg(F.sum("homes").alias("homes")).collect())
    dealt = deal_out(sizes, part, chunk)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, at, x in _by_length(b):
                node, own, (n, first, of) = b.node.to_numpy()[at], part.home(d, x), dealt[d]
                spread = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                block = first[own] + (spread % n[own].astype(np.uint64)).astype(np.int64)
                raw = [v if v.dtype == np.float32 else v.astype(np.float64) for v in b.embedding.to_numpy()[at]]
                yield pd.DataFrame({"d": d, "bundle": of[block], "block": block, "cell": own, "node": node, "m": b.m.to_numpy()[at],
                                    "wide": [v.dtype.itemsize for v in raw], "raw": [v.tobytes() for v in raw]})

    def pack(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("block", kind="stable")
        d, wide, raw = int(f.d.iloc[0]), int(f.wide.iloc[0]), b"".join(f.raw)
        near = part.products(d, _unit(_numbers(raw, wide, d)))
        first = np.flatnonzero(f.block.diff().to_numpy() != 0)
        lows, highs = (np.arccos(of.reduceat(near, first, axis=0)) for of in (np.maximum, np.minimum))
        return pd.DataFrame({"d": [d], "node": [f.node.to_numpy()], "m": [f.m.to_numpy()], "wide": [wide], "raw": [raw],
                             "low": [lows.min(axis=0)], "high": [highs.max(axis=0)], "cell": [f.cell.to_numpy()[first]],
                             "size": [np.diff(np.append(first, len(f)))], "lows": [lows.reshape(-1)], "highs": [highs.reshape(-1)]})

    made = (reps.select("node", "m", "embedding").mapInPandas(
        deal, "d int, bundle long, block long, cell int, node long, m long, wide int, raw binary")
        .groupBy("bundle").applyInPandas(pack, _BUNDLE).withColumn("id", F.monotonically_increasing_id()))
    # Large bundles get files of their own; small ones, as of rare lengths, share them.
    number, held = 1 + max((int(of.max()) for _, _, of in dealt.values()), default=0), sum(8 * r.d * r.homes for r in sizes)
    return stored(made, "vector-bundles", maxRecordsPerFile=max(1, BUNDLE_BYTES * number // max(1, held)))


def _numbers(raw: bytes, wide: int, d: int) -> np.ndarray:
    return np.frombuffer(raw, np.float32 if wide == 4 else np.float64).reshape(-1, d)


def pairs(b: DataFrame, part: Partition) -> DataFrame:
    """Each two bundles of ``b`` (with an id) that may have a link, as x and y, side by
    side: files of bundles meet files of bundles, nothing is exchanged."""
    x, y = (b.select(*[F.col(c).alias(f"{side}_{c}") for c in b.columns]) for side in "xy")
    near = [F.forall(F.zip_with(low, high, lambda least, most: least <= most + part.radius), lambda v: v)
            for low, high in (("x_low", "y_high"), ("y_low", "x_high"))]
    return x.hint("shuffle_replicate_nl").join(
        y, (F.col("x_d") == F.col("y_d")) & (F.col("x_id") <= F.col("y_id")) & near[0] & near[1])


class Block:
    """A block of a bundle made ready for products."""

    def __init__(self, raw: np.ndarray, cell: int, low: np.ndarray, high: np.ndarray, part: Partition):
        self.d, self.cell, self.low, self.high, self.raw = raw.shape[1], cell, low, high, raw
        x, p, axes = _unit(raw), part.pivots.get(self.d), part.axes.get(self.d)
        self.x = x.astype(np.float32)
        self.short = None if axes is None else _short(x, axes).astype(np.float32)
        self.near = np.zeros((len(x), 1)) if p is None else np.clip(x @ p[:BOUND_PIVOTS].T, -1.0, 1.0)
        self.own = None if p is None else _angles(x, p[[cell]])[:, 0]

    def meets(self, other: Block, part: Partition) -> bool:
        r = part.radius
        return bool((self.low <= other.high + r).all() and (other.low <= self.high + r).all())

    def facing(self, other: Block, part: Partition) -> np.ndarray:
        """Rows that may have a link to ``other``."""
        k, r, p = self.near.shape[1], part.radius, part.pivots.get(self.d)
        to = ((self.near <= np.cos(np.maximum(other.low[:k] - r, 0))) & (self.near >= np.cos(np.minimum(other.high[:k] + r, np.pi)))).all(axis=1)
        if p is not None:
            near = self.x @ p[other.cell].astype(np.float32) + self.d * 4e-7
            to &= near >= np.cos(np.minimum(np.minimum(self.own + 2 * r, other.high[other.cell] + r), np.pi))
        return np.flatnonzero(to)


def hits(x: Block, y: Block, part: Partition, cosine: float = COSINE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """Rows of x and rows of y that link, in parts: pair by pair, or with a matrix that tells which do."""
    rows, cols = x.facing(y, part), y.facing(x, part)
    if not len(rows) or not len(cols):
        return
    low = np.float32(cosine - (x.d + 8) * 2.4e-7)
    high = np.float32(cosine + (x.d + 8) * 2.4e-7)
    short = None if x.short is None else (x.short[rows], y.short[cols])
    room, left = np.empty(TILE * TILE, np.float32), []
    for r in range(0, len(rows), TILE):
        for c in range(0, len(cols), TILE):
            n, w = min(TILE, len(rows) - r), min(TILE, len(cols) - c)
            s = room[:n * w].reshape(n, w)
            if short is not None:
                some = np.flatnonzero(np.matmul(short[0][r:r + n], short[1][c:c + w].T, out=s).max(axis=1) >= low)
                if not len(some):
                    continue
                open_ = s[some] >= low
                if np.count_nonzero(open_) <= n * w // 64:
                    i, j = np.nonzero(open_)
                    left.append((r + some[i], c + j))
                    continue
            if np.matmul(x.x[rows[r:r + n]], y.x[cols[c:c + w]].T, out=s).max() < low:
                continue
            yield rows[r:r + n], cols[c:c + w], s >= high
            i, j = np.nonzero((s >= low) & (s < high))
            left.append((r + i, c + j))
    if not left:
        return
    i, j = (np.concatenate(at) for at in zip(*left))
    for k in range(0, len(i), 50_000):
        u, v = rows[i[k:k + 50_000]], cols[j[k:k + 50_000]]
        linked = np.einsum("ij,ij->i", _unit(x.raw[u]), _unit(y.raw[v])) >= cosine
        yield u[linked], v[linked], None


class Forest:
    """Counts and a spanning forest over the vectors that a task has seen."""

    def __init__(self):
        self.at, self.node, self.m = {}, np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.count, self.parent, self.edges = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def place(self, key: int, node: np.ndarray, m: np.ndarray) -> int:
        """Where the vectors of bundle ``key`` begin."""
        if key not in self.at:
            self.at[key] = n = len(self.node)
            self.node, self.m = np.append(self.node, node), np.append(self.m, m)
            self.count = np.append(self.count, np.zeros(len(node), np.int64))
            self.parent = np.append(self.parent, np.arange(n, n + len(node)))
        return self.at[key]

    def roots(self, v: np.ndarray) -> np.ndarray:
        up = self.parent[v]
        while (up != (higher := self.parent[up])).any():
            up = higher
        self.parent[v] = up
        return up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Each root is hung below the least smaller one it meets, until ends agree."""
        while True:
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            a, b = np.divmod(np.unique(np.maximum(a, b) * len(self.node) + np.minimum(a, b)), len(self.node))
            first = np.append(True, a[1:] != a[:-1])
            self.parent[a[first]] = b[first]
            self.edges.append(np.column_stack([a[first], b[first]]))

    def met(self, x: int, y: int, i: np.ndarray, j: np.ndarray, hit: np.ndarray | None) -> None:
        """``hits`` of the block at x with the block at y; of a block with itself, both ways are there."""
        i, j = x + i, y + j
        if hit is None:
            i, j = (i, j) if x != y else (i[i != j], j[i != j])
            np.add.at(self.count, i, self.m[j])
            if x != y:
                np.add.at(self.count, j, self.m[i])
            self.link(i, j)
            return
        if x == y:
            hit &= i[:, None] != j[None, :]
        weight = hit.astype(np.float64)
        self.count[i] += (weight @ self.m[j]).astype(np.int64)
        if x != y:
            self.count[j] += (weight.T @ self.m[i]).astype(np.int64)
        # One link of each row and column joins most; what is apart then is few.
        some, of = hit.any(axis=1), hit.any(axis=0)
        self.link(np.append(i[some], i[hit.argmax(axis=0)[of]]), np.append(j[hit.argmax(axis=1)[some]], j[of]))
        a, b = np.nonzero(hit & (self.roots(i)[:, None] != self.roots(j)[None, :]))
        self.link(i[a], j[b])

    def rows(self, size: int = 100_000) -> Iterator[pa.RecordBatch]:
        """(u, null, links of u) and connecting edges (u, v, 0)."""
        some = np.flatnonzero(self.count)
        e = self.node[np.concatenate([*self.edges, np.zeros((0, 2), np.int64)])]
        for at in range(0, len(some), size):
            f = some[at:at + size]
            yield _links(self.node[f], None, self.count[f])
        for at in range(0, len(e), size):
            f = e[at:at + size]
            yield _links(f[:, 0], f[:, 1], np.zeros(len(f), np.int64))


def _links(u: np.ndarray, v: np.ndarray | None, c: np.ndarray) -> pa.RecordBatch:
    v = pa.nulls(len(u), pa.int64()) if v is None else pa.array(v, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), v, pa.array(c, pa.int64())], ["u", "v", "c"])


class Bundle:
    """The blocks of side x or y of row k of ``pairs``."""

    def __init__(self, batch: pa.RecordBatch, k: int, side: str, part: Partition):
        def of(name):
            return batch.column(f"{side}_{name}")[k]

        self.node, self.m, cell, size, lows, highs = (of(c).values.to_numpy() for c in ("node", "m", "cell", "size", "lows", "highs"))
        raw = _numbers(of("raw").as_buffer(), of("wide").as_py(), of("d").as_py()).copy()
        ends = np.cumsum(size)
        self.first = ends - size
        self.blocks = [Block(raw[f:e], c, low, high, part) for f, e, c, low, high in
                       zip(self.first, ends, cell.tolist(), lows.reshape(len(size), -1).copy(), highs.reshape(len(size), -1).copy())]


def join_bundles(part: Partition, cosine: float = COSINE):
    """Of pairs of bundles, by task: link weights (u, null, c) and connecting edges (u, v, 0)."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, x_id, x = Forest(), None, None
        for batch in batches:
            for k in range(batch.num_rows):
                a, b = (batch.column(c)[k].as_py() for c in ("x_id", "y_id"))
                if a != x_id:
                    x_id, x = a, Bundle(batch, k, "x", part)
                    at_x = forest.place(a, x.node, x.m)
                y = x if a == b else Bundle(batch, k, "y", part)
                at_y = forest.place(b, y.node, y.m)
                for n, (f, one) in enumerate(zip(x.first, x.blocks)):
                    for g, other in list(zip(y.first, y.blocks))[n if a == b else 0:]:
                        if one.meets(other, part):
                            for found in hits(one, other, part, cosine):
                                forest.met(int(at_x + f), int(at_y + g), *found)
        yield from forest.rows()

    return join


def _key(embedding: str = "embedding"):
    return F.xxhash64(embedding)


def near_vectors(vectors: DataFrame, cosine: float = COSINE, chunk: int = CHUNK) -> DataFrame:
    """``vectors`` (vec_id, embedding) with n_links, component_id and kept."""
    own = vectors.select("vec_id", "embedding")
    reps = stored(own.filter(valid()).groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("m"))
                  .withColumn("node", F.monotonically_increasing_id()).withColumn("key", _key()), "vectors")
    part = partition(reps, cosine, chunk)
    found = stored(pairs(bundles(reps, part, chunk), part).mapInArrow(join_bundles(part, cosine), "u long, v long, c long"), "vector-links")
    count = found.filter("v is null").groupBy("u").agg(F.sum("c").alias("c"))
    comp = components(found.filter("v is not null").select("u", "v"))
    node = (reps.join(count.hint("shuffle_merge"), F.col("node") == F.col("u"), "left")
            .select("node", "rep", "m", "key", F.coalesce("c", F.lit(0)).alias("c"))
            .join(comp.select(F.col("node").alias("n"), "component").hint("shuffle_merge"), F.col("node") == F.col("n"), "left")
            .withColumn("component", F.coalesce("component", "node")))
    node = stored(node.select("node", "component", "rep", "key", (F.col("c") + F.col("m") - 1).alias("n_links")), "vector-nodes")
    name = node.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = stored(lookup(node, name, ["component"]).select("node", "key", "n_links", "component_id"), "vector-named")
    linked = _found(own.filter(valid()), reps, named)
    alone = own.filter(~valid()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (linked.unionByName(alone)
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def _found(rows: DataFrame, reps: DataFrame, named: DataFrame) -> DataFrame:
    """What ``named`` has for the vector of each row: by its key, and by the vector where vectors share a key."""
    shared = named.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    to, columns = rows.withColumn("key", _key()), ["vec_id", "n_links", "component_id"]
    if shared.isEmpty():
        return lookup(to.select("vec_id", "key"), named.drop("node"), ["key"]).select(*columns)
    alike = named.join(shared, "key").join(reps.select("node", "embedding"), "node").drop("node")
    by_key = lookup(to.select("vec_id", "key"), named.join(shared, "key", "left_anti").drop("node"), ["key"])
    by_vector = lookup(to.join(shared, "key"), alike, ["key", "embedding"])
    return by_key.select(*columns).unionByName(by_vector.select(*columns))


def op3_embedding_join(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
    embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
l AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.ok AND b.ok
    AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
r AS (SELECT vec_id AS u, vec_id AS v FROM v UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u AS vec_id, min(v) AS component_id FROM r GROUP BY u),
n AS (SELECT u AS vec_id, count(*) AS n_links FROM l GROUP BY u)
SELECT c.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
FROM c LEFT JOIN n ON c.vec_id = n.vec_id
"""
