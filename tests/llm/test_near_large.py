"""Documents of a large bucket meet on rare shingles only where they can link."""
import random
from collections import Counter

from pyspark.sql import functions as F

from blotter.llm import nearcopies as N


def test_rare_shingles_join_what_can_link(spark):
    deal, s = random.Random(1), N.SIMILARITY
    docs = {i: [1000 * (i % 6 + 1) + x for x in range(deal.randint(30, 36))] + [10 ** 6 + 100 * i + x for x in range(deal.randint(0, 6))]
            for i in range(48)}
    part = {i: i if i % 4 else i // 8 * 4 for i in docs}
    members = spark.createDataFrame([(1, i, len(h), 0, part[i], 0) for i, h in docs.items()],
                                    "key long, rep long, n int, leader long, component long, _lead long")
    least = (F.col("n") + F.col("n2")) * (s / (1 + s)) - 1e-6
    met = N._across_large(members, spark.createDataFrame(list(docs.items()), "rep long, h array<int>"), s, least)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert any("Join [s#" in line and "NOT (component#" in line for line in plan.splitlines())
    # All shingles are rare here: at most 8 documents hold one.
    want = {(a, b) for a in docs for b in docs if a < b and part[a] != part[b]
            and sum((Counter(docs[a]) & Counter(docs[b])).values()) >= (len(docs[a]) + len(docs[b])) * s / (1 + s) - 1e-6}
    assert want and {tuple(r) for r in met.filter(N._alike_in_length(s)).select("a", "b").distinct().collect()} == want


def test_shingles_of_one_document_join_nothing(spark, monkeypatch):
    """The join on rare shingles makes rows only for those that several documents have."""
    s, made, stored = N.SIMILARITY, {}, N.stored

    def seen(df, name):
        made[name] = stored(df, name)
        return made[name]

    monkeypatch.setattr(N, "stored", seen)
    common = list(range(1, 61))  # frequent: all 40 documents have them
    docs = {i: common + [1000 + i // 4 * 10 + x for x in range(5)] + [10 ** 6 + 1000 * i + x for x in range((2, 8, 8, 60)[i % 4])] for i in range(40)}
    docs[40] = [9 * 10 ** 6] * (N.RARE + 4) + common  # one document repeats its own shingle often
    members = spark.createDataFrame([(1, i, len(h), 41, i, 41) for i, h in docs.items()],
                                    "key long, rep long, n int, leader long, component long, _lead long")
    least = (F.col("n") + F.col("n2")) * (s / (1 + s)) - 1e-6
    met = N._across_large(members, spark.createDataFrame(list(docs.items()), "rep long, h array<int>"), s, least)
    got = {tuple(r) for r in met.filter(N._alike_in_length(s)).select("a", "b").distinct().collect()}
    held = Counter(x for h in docs.values() for x in set(h))
    assert made["copies-rare"].count() == sum(d for x, d in held.items() if 1 < d <= N.RARE) == 200
    # Every pair that has enough in common is there; at most 16 places are rare.
    want = {(a, b) for a in docs for b in docs if a < b
            and sum((Counter(docs[a]) & Counter(docs[b])).values()) >= (len(docs[a]) + len(docs[b])) * s / (1 + s) - 1e-6}
    assert want and want <= got
