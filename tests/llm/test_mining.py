"""Operators 11 to 13 against brute force, and odd inputs."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.llm import clusters, negatives, pii
from blotter.llm.common import running, whole

CLASHING = ["row", "d", "a", "b", "v2", "n", "m", "rank", "score", "_row", "key"]


def with_clashes(df):
    for i, c in enumerate(CLASHING):
        df = df.withColumn(c, F.lit(i))
    return df


def test_running(spark):
    rng = random.Random(1)
    rows = [[rng.randrange(9) for _ in range(n)] for n in (0, 1, 255, 256, 257, 512, 1000)]
    df = spark.createDataFrame([(r,) for r in rows], "x array<int>")
    for r in df.select("x", running(F.col("x"), lambda a, b: a + b).alias("s"), running(F.col("x"), F.greatest).alias("g")).collect():
        assert r.s == [sum(r.x[:i]) for i in range(len(r.x) + 1)]
        assert r.g == [max([0, *r.x[:i]]) for i in range(len(r.x) + 1)]


def test_whole(spark):
    rows = [([0.5, -0.001, 1e300, -1e300],)]
    got = spark.createDataFrame(rows, "e array<double>").select(whole("e").alias("v")).first().v
    assert got == [128, -1, 2 ** 63 - 1, -2 ** 63]


# ---------------------------------------------------------------- hard negatives
@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.integers(0, 62), st.integers(0, 10 ** 6))
def test_packed_products_are_exact(n, bits, seed):
    rng = random.Random(seed)
    d = rng.randrange(1, 9)
    draw = lambda k: np.array([[rng.randint(-(1 << bits), 1 << bits) for _ in range(d)] for _ in range(k)], dtype=np.int64)
    a, c = draw(rng.randrange(1, 5)), draw(n)
    got = negatives.Packed(c, int(a.min()), int(a.max())).scores(a)
    assert got.shape == (len(a), n)
    assert all(int(got[i, j]) == sum(int(x) * int(y) for x, y in zip(a[i], c[j])) for i in range(len(a)) for j in range(n))


def test_several_candidates_share_an_integer():
    c = np.arange(-128, 128).repeat(64).reshape(256, 64)
    p = negatives.Packed(c, -128, 127)
    assert p.kind is float and p.fields == 2 and p.wide.shape == (64, 128)


def brute_negatives(rows):
    """(vec_id, label, anchor, v) -> sorted triples."""
    rows, out = sorted(set((i, y, a, tuple(v)) for i, y, a, v in rows)), []
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    for n, (i, y, a, v) in enumerate(rows):
        if not a:
            continue
        other = [(dot(v, w), j, k, z) for k, (j, z, _, w) in enumerate(rows) if k != n and len(w) == len(v)]
        near = sorted((-s, j, k) for s, j, k, z in other if z == y)[:5]
        for s, j, _ in near:
            s = -s
            far = sorted((-t, m) for t, m, _, z in other if z != y and 50 * s <= 100 * t <= 95 * s)[:3]
            out += [(i, j, r + 1, m, s, -t) for r, (t, m) in enumerate(far)]
    return sorted(out)


@pytest.mark.parametrize("span,chunk", [(6, 16), (300, 64), (1 << 29, 50)])
def test_hard_negatives_equal_brute_force(spark, span, chunk):
    rng = random.Random(span)
    # Label 0 holds most rows; small spans make many ties.
    rows = [(i, rng.choice([0, 0, 0, 1, 2]), i % 5 == 0, [rng.randrange(span) - span // 4 for _ in range(4)]) for i in range(150)]
    rows += [(7, 1, False, rows[3][3]), (3, rows[3][1], False, rows[3][3]), (200, 0, True, [1, 2]), (201, 0, False, [2, 2]),
             (202, 1, False, [1, 1]), (203, 1, True, []), (204, 1, False, []), (205, 0, False, [])]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, label int, anchor boolean, v array<long>").repartition(3))
    got = negatives.hard_negatives(df, chunk=chunk)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)


def test_hard_negatives_odd_rows(spark):
    rows = [(0, 1, True, [1]), (None, 1, True, [1]), (2, None, False, [1]), (3, 1, False, None), (4, 1, None, [1]), (5, 2, False, [1])]
    df = spark.createDataFrame(rows, "vec_id long, label int, anchor boolean, v array<long>")
    assert negatives.hard_negatives(df).count() == 0          # the only positive scores 1: a negative would need 0.5 to 0.95
    assert negatives.hard_negatives(df.limit(0)).count() == 0
    huge = [(0, 1, True, [2 ** 62]), (1, 1, False, [2 ** 62]), (2, 2, False, [2 ** 61])]
    df = spark.createDataFrame(huge, "vec_id long, label int, anchor boolean, v array<long>")
    assert negatives.hard_negatives(df).count() == 0          # both scores hold the largest long: 100 % of it


# ---------------------------------------------------------------- clusters
def brute_clusters(rows, k, rounds, seed="2:"):
    start = sorted((hashlib.sha256(f"{seed}{i}".encode()).hexdigest(), tuple(v)) for i, v in rows if i is not None)[:k]
    c = [list(v) for _, v in start]
    dist = lambda x, y: sum((p - q) ** 2 for p, q in zip(x, y))
    near = lambda v: min((dist(v, x), j) for j, x in enumerate(c))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in rows:
            of[near(v)[1]].append(v)
        for j, m in of.items():
            c[j] = [sum(x) // len(m) for x in zip(*m)]
    return sorted(((i, near(v)[1], min(near(v)[0], 2 ** 63 - 1)) for i, v in rows), key=str), c


@pytest.mark.parametrize("spread,centre,k", [(30, 200, 7), (3, 1000, 12), (2, 2, 5), (10, 1 << 40, 4)])
def test_clusters_equal_brute_force(spark, spread, centre, k):
    rng = random.Random(spread * centre)
    centres = [[rng.randrange(-centre, centre) for _ in range(3)] for _ in range(6)]
    rows = [(i if i % 40 else None, [x + rng.randrange(-spread, spread + 1) for x in rng.choice(centres)]) for i in range(300)]
    rows += rows[5:9]
    df = with_clashes(spark.createDataFrame(rows + [(998, [1, 2]), (999, None)], "vec_id long, v array<long>").repartition(3))
    found, c = clusters.cluster_vectors(df, k, 4, 3)
    want, centroids = brute_clusters(rows, k, 4)
    assert c.tolist() == centroids
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str) == want


def test_clusters_few_vectors(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [5, 5])], "vec_id long, v array<long>")
    found, c = clusters.cluster_vectors(df, 40, 3, 2)
    assert len(c) == 2 and {r.distance for r in found.collect()} == {0}
    found, c = clusters.cluster_vectors(df.limit(0), 40, 3, 2)
    assert found.count() == 0 and not len(c)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_loosening_bounds_every_fall(seed):
    rng = np.random.default_rng(seed)
    k, d = int(rng.integers(2, 6)), int(rng.integers(1, 5))
    old = rng.integers(-50, 50, (k, d))
    new = old + rng.integers(-20, 21, (k, d)) * (rng.random((k, 1)) < 0.8)
    radius = rng.random(k) * 40
    fall = clusters.loosening(old, new, radius)
    for i in range(k):
        u = rng.normal(size=(200, d))
        x = old[i] + u / np.linalg.norm(u, axis=1)[:, None] * (rng.random((200, 1)) * radius[i])
        for j in range(k):
            if j != i:
                real = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert real.max() <= fall[i] + 1e-6
    assert (fall <= np.linalg.norm(new - old, axis=1).max() + 1e-9).all()


def test_bounds_spare_searches(spark):
    """On clustered vectors most are never searched for again, and the bounds
    fall less than by the largest drift."""
    rng = np.random.default_rng(4)
    centres = rng.integers(-2000, 2000, (8, 16))
    rows = [(i, (centres[i % 8] + rng.integers(-40, 41, 16)).tolist()) for i in range(2000)]
    found, _ = clusters.cluster_vectors(spark.createDataFrame(rows, "vec_id long, v array<long>"), 8, 3, 16)
    assert found.filter("searched").count() < 1000
    old = np.array([[0, 0], [100, 0], [0, 100]])
    fall = clusters.loosening(old, old + np.array([[0, 0], [0, 30], [0, 0]]), np.array([5.0, 5.0, 5.0]))
    assert fall[0] < 3 and fall[2] < 25 and fall[1] == 0


# ---------------------------------------------------------------- personal data
def luhn(s):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(s))) % 10 == 0


def brute_base(text):
    out, digits = [], lambda s: re.sub("[^0-9]", "", s)
    ok = {"email": lambda v: True, "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
          "card": lambda v: 16 <= len(digits(v)) <= 19 and luhn(digits(v)), "phone": lambda v: 8 <= len(digits(v)) <= 15}
    for k in pii.KINDS:
        out += [(k.name, m.start(), m.end()) for m in re.finditer(k.given, text or "") if ok[k.name](m.group())]
    return out


_NAME = [k.name for k in pii.KINDS] + [f"like_{k.name}" for k in pii.KINDS]


def spans(rows):
    return {r.doc_id: [(_NAME[s.kind], s.start, s.end) for s in [*r.base, *r.learned]] for r in rows}


HARD = ["a@b.cc_d@e.ff", "a@b", "x@y.z.", "..a@b.c@d.e", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.255", "0.0.0.0x", "4111 1111 1111 1111",
        "4111-1111-1111-1111 4111-1111-1111-1112", "4111111111111111 4111111111111111", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7", "+1 (017) 555-7713.",
        "+49 30 12", "+1++44 20 7946 0958 ", "é+1 (017) 555-7713é ü@ü.de u@ü.de", "tel+49(0)30-123456 7", "", None, "12 34abc5", "(@)", "a@@b.c"]


def test_base_rules_equal_the_given_ones(spark):
    rng = random.Random(9)
    docs = list(HARD)
    for _ in range(300):
        docs.append("".join(rng.choice(["a", "@", ".", "1", "4111", "-", " ", "+", "(", ")", "é", "b.c", "5 5", "_", "0"]) for _ in range(rng.randrange(60))))
    df = with_clashes(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    got = spans(pii.find_personal(df).collect())
    assert got == {i: brute_base(t) for i, t in enumerate(docs)}


def test_long_texts(spark):
    """Texts on which a plain search would repeat work, and one with very many matches."""
    docs = ["x" * 300_000, "1" * 300_000, "a@" + "b." * 50_000, "+1" + " " * 300_000, "1 " * 150_000, "(" * 200_000 + "1", "1.1." * 50_000,
            "u@b.cc " * 40_000, "9 " + "(" * 200_000]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: (len(r.base), r.base[-1].end if r.base else None) for r in pii.find_personal(df).collect()}
    assert got[7] == (40_000, 7 * 40_000 - 1) and got[2] == (1, 99_999 + 2) and got[0] == (0, None) and got[1] == (0, None)


def contact_corpus():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    phone = lambda: "%d %04d %d" % (rng.randrange(20, 99), rng.randrange(10 ** 4), rng.randrange(100, 999))
    docs = []
    for i in range(60):
        docs.append(f"{word()} {word()} call us: +49 {phone()} {word()}")
        docs.append(f"{word()} in room {rng.randrange(100)} {word()} {word()}")
    # Behind a learned pattern, then behind one that only discovered instances support.
    hidden = [phone() for _ in range(12)]
    docs += [f"{word()} call us: {p} {word()}" for p in hidden]
    docs += [f"{word()} ring desk {p} {word()}" for p in hidden]
    docs += [f"{word()} ring desk {phone()} {word()}", f"{word()} total sum {phone()}", f"order number {rng.randrange(10 ** 6, 10 ** 7)}"]
    return docs


def brute_learned(docs):
    """The method in plain Python, over whole texts."""
    space, part = " \t\n\v\f\r", r"[^\x20\x09-\x0D]"

    def pattern(before, first):
        near = (("" if first else "# ") + before)[-pii.REACH:].lower()
        return " ".join(re.findall(f"{part}+", re.sub(f"{part}*[0-9@]{part}*", "#", near))[-2:])

    key = lambda v: re.sub("[^A-Za-z0-9@]", "", v).lower()
    uses = []
    for doc, text in enumerate(docs):
        base = []
        for n, k in enumerate(pii.KINDS):
            last, good = 0, {(s, e) for name, s, e in brute_base(text) if name == k.name}
            for i, m in enumerate(re.finditer(k.given, text)):
                if m.span() in good:
                    base.append((doc, n, *m.span(), pattern(text[last:m.start()], i == 0), key(m.group()), ""))
                last = m.end()
        last = 0
        for i, m in enumerate(re.finditer(pii.MENTION.given, text)):
            v = m.group().lstrip(pii._LEAD)
            s = m.end() - len(v)
            v = v.rstrip(pii._TAIL)
            if v and not any(b[2] < s + len(v) and b[3] > s for b in base):
                uses.append((doc, 4, s, s + len(v), pattern(text[last:m.start()], i == 0), key(v), v))
            last = m.end()
        uses += base
    edges = {(u[4], u[5]) for u in uses if u[4].strip(space)}
    of, held = defaultdict(set), defaultdict(set)
    for p, k in edges:
        of[p].add(k)
        held[k].add(p)
    seeds = {(u[5], u[1]): pii.FULL for u in uses if u[1] < 4}
    score = dict(seeds)
    for _ in range(pii.ROUNDS):
        sure = {}
        for p, keys in of.items():
            for n in range(4):
                s = [score.get((k, n), 0) for k in keys]
                if sum(x >= pii.BELIEVED for x in s) >= pii.SUPPORT:
                    sure[p, n] = sum(s) // len(keys)
        score = {(k, n): max(sure.get((p, n), 0) for p in ps) for k, ps in held.items() for n in range(4)} | seeds
    out = defaultdict(list)
    for doc, kind, s, e, p, _, v in uses:
        best = max(((c, -n) for (q, n), c in sure.items() if q == p and c >= pii.ACCEPT), default=None)
        digits, letters = len(re.sub("[^0-9]", "", v)), re.search("[A-Za-z]", v)
        if kind == 4 and best:
            fits = [bool(re.search("[A-Za-z0-9]@[A-Za-z0-9]", v)), bool(re.search("[0-9][.:][0-9]", v)) and not letters and digits >= 4,
                    12 <= digits <= 19 and not letters, 7 <= digits <= 15 and not letters]
            if fits[-best[1]]:
                out[doc].append((_NAME[4 - best[1]], s, e))
    return {d: sorted(x) for d, x in out.items()}


def test_patterns_discover_identifiers(spark):
    docs = contact_corpus()
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(4)
    got = {d: x for d, x in ((d, sorted(s for s in x if s[0].startswith("like"))) for d, x in spans(pii.find_personal(df).collect()).items()) if x}
    assert got == brute_learned(docs)
    # The twelve behind the learned pattern, the same behind the discovered one, and one that is new there.
    assert len(got) == 25 and all(x[0][0] == "like_phone" for x in got.values())


def test_personal_odd_rows(spark):
    rows = [(1, "mail a@b.cc"), (1, "mail a@b.cc"), (1, "other"), (None, "c@d.ee +1 (017) 555-7713"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.find_personal(df)
    assert got.count() == len(rows) and pii.find_personal(df.limit(0)).count() == 0
    assert sorted(len(r.base) for r in got.collect()) == [0, 0, 0, 1, 1, 2]
