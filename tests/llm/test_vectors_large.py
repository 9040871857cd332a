"""Vectors meet without being repeated, and find their result whatever their keys."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import neighbours as N


def spread(n, copies, seed=5):
    """Evenly spread vectors of 64 numbers, some near and some exact copies of others."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    near = np.repeat(x[:copies], 3, axis=0) + 0.1 * rng.normal(size=(3 * copies, 64))
    hot = x[-1] + 0.05 * rng.normal(size=(4 * copies, 64))
    return np.concatenate([x, near, hot, x[:copies]]).astype(np.float32)


def expected(x):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    low = np.arange(len(x))
    while (low != (to := np.where(link, low, len(x)).min(axis=1).clip(max=low))).any():
        low = to
    return {i: (int(link[i].sum()), int(low[i])) for i in range(len(x))}


def found(df, **options):
    return {r.vec_id: (r.n_links, r.component_id) for r in N.near_vectors(df, **options).collect()}


def test_spread_vectors_are_not_repeated(spark, monkeypatch):
    """No step makes more rows than there are vectors, though nearly all cells must meet."""
    x = spread(400, 20)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    made = []
    for name in ("mapInPandas", "mapInArrow"):
        def seen(self, f, schema, *rest, plain=getattr(type(df), name)):
            out = plain(self, f, schema, *rest)
            made.append(out.count())
            return out
        monkeypatch.setattr(type(df), name, seen)
    assert found(df, chunk=16) == expected(x)
    assert made and max(made) <= len(x)


def test_vectors_that_share_a_key(spark, monkeypatch):
    x = spread(60, 5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    want = expected(x)
    monkeypatch.setattr(N, "_key", lambda: F.pmod(F.xxhash64("embedding"), F.lit(40)))
    assert found(df) == want
    monkeypatch.setattr(N, "_key", lambda: F.lit(1).cast("long"))
    assert found(df) == want


@pytest.mark.parametrize("kind,seed", [("double", 1), ("float", 2)])
def test_lengths_meet_their_own(spark, kind, seed):
    """Vectors of several lengths, one of them rare, some cells in several bundles."""
    x = spread(150, 10, seed)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    other = [(1000 + i, v[:24].tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([*rows, *other, (5000, [1.0, 2.0]), (5001, [2.0, 4.0])], f"vec_id long, embedding array<{kind}>")
    want = expected(x) | {1000 + i: (n, 1000 + c) for i, (n, c) in expected(x[:, :24]).items()} | {5000: (1, 5000), 5001: (1, 5000)}
    assert found(df, chunk=4) == want
