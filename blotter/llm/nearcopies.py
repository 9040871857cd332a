"""Operator 10: near duplicates by Order MinHash and banded alignment.

Words are runs of letters and digits, lower-cased; shingles are ``SHINGLE``
words. Each of ``SKETCHES`` hash functions takes the ``PICKED`` smallest
occurrence-labelled shingles of a document and keeps them in text order, so a
sketch is shared only where the same shingles stand in the same order. Two
documents that share a sketch are candidates; they link if their shingles,
aligned in order within a band, agree to ``SIMILARITY``: m / (a + b - m) for m
aligned of a and b shingles. The band is as wide as that bound allows.

Documents with the same words are one class from the start and only their
smallest id is sketched further. Not every pair of a bucket is compared: each
member is compared with the bucket's most connected one, then only members
that are still in different components are, as far as they can have enough
shingles in common. So every pair that shares a
sketch is compared, known to be connected, or known not to link. At similarity
0.8 a pair shares no sketch with probability 0.0003 at most, less above.

Few shingles would miss more, so a pair with a text below ``SHORT`` shingles is
found exactly: texts that can be in one have their rarest labelled shingles
(so many that two texts which agree to ``SIMILARITY`` have one of them in
common) as keys beside the sketches, or, below ``SHORT``, instead of them.

Defined cases: null, empty and wordless texts are classes of their own; texts
below ``SHINGLE`` words are copies only if their words are equal; rows that
repeat an id with a text are one document; an id with several texts stands in
the class of each, and has the smallest of them as its own; rows without id have
no class and are kept.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from .common import components, lookup, packed, small_text_batches, stored, table, unpacked

SHINGLE = 5
SIMILARITY = 0.8
PICKED = 5
SKETCHES = 22
#: Pairs with a text of fewer shingles than this do not depend on sketches.
SHORT = 40
_WORD = re.compile(r"[^\W_]+")
_CACHE_WORDS = 500_000
#: Buckets up to this size compare what is apart in them pair by pair; larger
#: ones first bound what a pair can have in common (the links are the same).
SMALL_BUCKET = 16
#: Places a shingle may have to count as rare for that bound.
RARE = 16
#: Elements of a block of sketch hashes.
_BLOCK = 1 << 20
_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SKETCHES, dtype=np.uint64)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """word -> 64-bit hash, forgotten when it grows too large."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode())
        return h


def word_hashes(text: str | None, cache: dict) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, _WORD.findall((text or "").lower())), dtype=np.uint64)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        h = h * _PRIME + words[i:i + n]
    return _mixed(h)


def occurrences(h: np.ndarray) -> np.ndarray:
    """How many equal elements stand before each."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(h) else np.zeros(0, dtype=np.int64)
    out = np.empty(len(h), dtype=np.int64)
    out[order] = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    return out


def labelled(h: np.ndarray) -> np.ndarray:
    return _mixed(h + occurrences(h).astype(np.uint64) * _PRIME)


def sketch(h: np.ndarray, picked: int = PICKED, sketches: int = SKETCHES) -> np.ndarray:
    """Keys of the ordered sketches of the shingle hashes ``h``; none for none."""
    n = len(h)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    own = labelled(h)
    keys, step, take = [], max(1, _BLOCK // n), min(picked, n)
    for at in range(0, sketches, step):
        rows = own[None, :] * _MULTIPLY[at:at + step, None] + _ADD[at:at + step, None]
        low = np.argpartition(rows, take - 1, axis=1)[:, :take] if take < n else np.broadcast_to(
            np.arange(n), (len(rows), n))
        chosen = h[np.sort(low, axis=1)]
        key = np.arange(at, at + len(rows), dtype=np.uint64)
        for i in range(take):
            key = key * _PRIME + chosen[:, i]
        keys.append(_mixed(key))
    return np.concatenate(keys)


def _ordered(a: np.ndarray, b: np.ndarray, band: int) -> tuple[int, int]:
    """(labelled shingles in common within the band, those of them in the same order)."""
    def labelled(x):
        occ = occurrences(x)
        return x.astype(np.uint64) + (occ.astype(np.uint64) << np.uint64(32))

    _, i, j = np.intersect1d(labelled(a), labelled(b), assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    near = np.abs(i - j) <= band
    tails: list[int] = []
    for x in j[near].tolist():
        at = bisect_left(tails, x)
        if at == len(tails):
            tails.append(x)
        else:
            tails[at] = x
    return len(i), len(tails)


def _common(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Longest common subsequence if it has at least ``least`` elements, else 0:
    furthest-reaching diagonals within the band that ``least`` allows."""
    n, m = len(a), len(b)
    most = n + m - 2 * least
    reach = {1: 0}
    for d in range(most + 1):
        for k in range(-d, d + 1, 2):
            x = reach.get(k + 1, 0) if k == -d or (k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1)) else reach[k - 1] + 1
            y = x - k
            while x < n and y < m:
                w = min(64, n - x, m - y)
                same = a[x:x + w] == b[y:y + w]
                run = w if same.all() else int(np.argmin(same))
                x, y = x + run, y + run
                if run < w:
                    break
            reach[k] = x
            if x >= n and y >= m:
                return (n + m - d) // 2
    return 0


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether shingle sequences a and b agree, in order, to ``similarity``."""
    total = len(a) + len(b)
    least = int(np.ceil(similarity * total / (1 + similarity) - 1e-9))
    if not len(a) or not len(b) or min(len(a), len(b)) < least:
        return False
    common, ordered = _ordered(a, b, total - 2 * least)
    if common < least or ordered >= least:
        return common >= least
    return _common(a, b, least) >= least


def sketches(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, digest, n, keys, short) of every row with an id; short: labelled
    shingles of a text that can agree with one below ``SHORT`` shingles."""
    few, none = SHORT, np.zeros(0, dtype=np.uint64)
    most = (few - 1) / similarity + 1e-9

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for b in batches:
            rows = []
            for doc, text in zip(b.doc_id, b.text):
                words = word_hashes(text, cache)
                h = shingles(words)
                keys = sketch(h) if len(h) >= few else none
                short = labelled(h) if len(h) <= most else none
                rows.append((doc, _digest(words, doc), len(h), keys.view(np.int64), short.view(np.int64)))
            yield pd.DataFrame(rows, columns=["doc_id", "digest", "n", "keys", "short"])

    return (docs.select("doc_id", "text").filter("doc_id is not null")
            .mapInPandas(work, "doc_id long, digest binary, n int, keys array<long>, short array<long>"))


def sequences(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, h): shingle hashes, 32 bits each, of the documents ``ids`` (rep)."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _Words()
        for b in batches:
            h = [(shingles(word_hashes(t, cache)) >> np.uint64(32)).astype(np.uint32).view(np.int32) for t in b.text]
            yield pd.DataFrame({"rep": b.rep, "h": h})

    return (docs.select(F.col("doc_id").alias("rep"), "text").join(ids.hint("shuffle_merge"), "rep")
            .mapInPandas(work, "rep long, h array<int>"))


def verify(pairs: DataFrame, sequence: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose sequences align; a may be hot."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [aligned(x.view(np.uint32), y.view(np.uint32), similarity) for x, y in zip(b.ha, b.hb)]
            yield b.loc[np.array(ok, dtype=bool), ["a", "b"]]

    second = pairs.join(sequence.select(F.col("rep").alias("b"), F.col("h").alias("hb")).hint("shuffle_merge"), "b")
    both = second.join(sequence.select(F.col("rep").alias("a"), F.col("h").alias("ha")).hint("shuffle_merge"), "a")
    return both.select("a", "b", "ha", "hb").mapInPandas(work, "a long, b long")


def _short_keys(reps: DataFrame, similarity: float) -> DataFrame:
    """(rep, n, key): prefix filter. Of n shingles, ordered by how many texts
    have them, the first n - ceil(similarity n) + 1 are kept; texts that agree
    share one. Those of a single text only take their places in the order."""
    shingle = stored(reps.filter(F.size("short") > 0).select("rep", "n", F.explode("short").alias("s")), "copies-short")
    often = shingle.groupBy("s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    own = (lookup(shingle, often, ["s"]).groupBy("rep", "n")
           .agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("e")))
    room = F.size("e") - F.ceil(F.col("n") * similarity - 1e-9).cast("int") + 1
    return (own.filter(room > 0).select("rep", "n", F.explode(F.slice("e", F.lit(1), room)).alias("x"))
            .select("rep", "n", F.col("x.s").alias("key")))


def _buckets(reps: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Members (key, rep, n, leader) of the sketches that several texts share.

    The leader is the member that shares most: with near copies of one text it
    is mostly that text, which is more like each copy than they are alike."""
    member = stored(reps.select("rep", "n", F.explode("keys").alias("key"))
                    .unionByName(_short_keys(reps, similarity)), "copies-members")
    size = member.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = stored(lookup(member, size, ["key"]), "copies-shared")
    weight = shared.groupBy("rep").agg(F.sum("size").alias("weight"))
    best = (shared.join(weight, "rep").groupBy("key")
            .agg(F.max(F.struct("weight", (-F.col("rep")).alias("m"))).alias("top"))
            .select("key", (-F.col("top.m")).alias("leader")))
    return stored(lookup(shared, best, ["key"]), "copies-buckets")


def _alike_in_length(similarity: float):
    return F.least("n", "n2") >= F.greatest("n", "n2") * similarity - 1e-9


def _across(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of a small bucket's members in different components of which
    one is not in the leader's."""
    apart = (members.filter("component <> _lead")
             .select("key", F.col("rep").alias("x"), F.col("component").alias("cx"), F.col("n").alias("n2")))
    new = ((F.col("component") != F.col("cx")) & (F.col("rep") != F.col("leader"))
           & ((F.col("component") == F.col("_lead")) | (F.col("rep") < F.col("x"))))
    return (members.join(apart, "key").filter(new)
            .select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b"), "n", "n2"))


def _across_frequent(members: DataFrame, similarity: float, least: Column) -> DataFrame:
    """Pairs as ``_across`` gives them whose smaller ``f`` reaches ``least``.

    Where n <= n2, that asks f >= 2 s n / (1 + s) of the shorter and f2 >= s n2 of
    the longer text (s: ``similarity``). Most texts that share boilerplate only
    meet neither, so they are gone before anything is paired."""
    own = members.filter(F.col("rep") != F.col("leader")).withColumn("_out", F.col("component") != F.col("_lead"))
    short = own.filter(F.col("f") >= F.col("n") * (2 * similarity / (1 + similarity)) - 1e-6)
    long = (own.filter(F.col("f") >= F.col("n") * similarity - 1e-6)
            .select("key", F.col("rep").alias("x"), F.col("component").alias("cx"), F.col("n").alias("n2"), F.col("f").alias("f2"), F.col("_out").alias("_out2")))
    met = short.filter("_out").join(long, "key").unionByName(short.filter("not _out").join(long.filter("_out2"), "key"))
    return (met.filter((F.col("n") <= F.col("n2")) & (F.col("component") != F.col("cx")) & (F.least("f", "f2") >= least))
            .select(F.least("rep", "x").alias("a"), F.greatest("rep", "x").alias("b"), "n", "n2"))


def _across_large(members: DataFrame, sequence: DataFrame, similarity: float, least: Column) -> DataFrame:
    """``_across`` for large buckets, without the pairs that cannot link.

    f: a document's shingles that other documents have too, in more than ``RARE``
    places. Documents that share r rarer ones align in no more than the smaller
    f plus r, so pairs come from members with enough frequent shingles, and from
    those that do share rare ones (at most RARE places each)."""
    docs = members.select("rep", "n", "component").distinct()
    # One row for each shingle of a document, however often it repeats there.
    shingle = stored(sequence.join(docs.select("rep").hint("shuffle_merge"), "rep").select("rep", F.explode("h").alias("s"))
                     .groupBy("rep", "s").agg(F.count(F.lit(1)).alias("k")), "copies-shingles")
    # What a single document has is only counted: it joins nothing.
    place = stored(shingle.groupBy("s").agg(F.sum("k").alias("c"), F.count(F.lit(1)).alias("docs"), F.min("rep").alias("rep"))
                   .filter((F.col("docs") == 1) | (F.col("c") <= RARE)), "copies-places")
    alone = place.filter("docs = 1").groupBy("rep").agg(F.sum("c").alias("alone"))
    # At most RARE rows for each of these keys.
    few = place.filter("docs > 1").select("s")
    rare = stored(shingle.join(few.hint("shuffle_merge"), "s"), "copies-rare")
    own = rare.groupBy("rep").agg(F.sum("k").alias("rare"))
    docs = (docs.join(alone.hint("shuffle_merge"), "rep", "left").join(own.hint("shuffle_merge"), "rep", "left")
            .withColumn("rare", F.coalesce("rare", F.lit(0))))
    docs = stored(docs.withColumn("f", F.col("n") - F.coalesce("alone", F.lit(0)) - F.col("rare")).drop("alone"), "copies-docs")
    frequent = _across_frequent(members.join(docs.select("rep", "f").hint("shuffle_merge"), "rep"), similarity, least)
    # Two documents meet on a shingle only where they can link at all: they are apart, alike
    # in length, and all rare shingles of the one with fewer would be enough.
    held = rare.join(docs.hint("shuffle_merge"), "rep").select("s", F.col("rep").alias("a"), "k", "n", "f", "rare", "component")
    second = held.select("s", *[F.col(c).alias(to) for c, to in (("a", "b"), ("k", "k2"), ("n", "n2"), ("f", "f2"), ("rare", "rare2"), ("component", "cb"))])
    enough = F.least("f", "f2") + F.least("rare", "rare2") >= least
    rarely = (held.join(second, "s")
              .filter((F.col("a") < F.col("b")) & (F.col("component") != F.col("cb")) & _alike_in_length(similarity) & enough)
              .groupBy("a", "b").agg(F.sum(F.least("k", "k2")).alias("r"), *[F.first(c).alias(c) for c in ("n", "n2", "f", "f2")])
              .filter(F.least("f", "f2") + F.col("r") >= least).select("a", "b", "n", "n2"))
    return frequent.unionByName(rarely)


def links(reps: DataFrame, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between representatives, enough to connect all that link."""
    bucket = _buckets(reps, similarity)
    n_of = reps.select(F.col("rep").alias("leader"), F.col("n").alias("n2")).hint("shuffle_merge")
    star = (bucket.filter("rep <> leader").select("leader", "rep", "n").distinct()
            .join(n_of, "leader").filter(_alike_in_length(similarity)))
    first = stored(star.select(F.col("leader").alias("a"), F.col("rep").alias("b")), "copies-pairs")
    held = bucket.select("rep").distinct()
    sequence = stored(sequences(docs, held), "copies-sequences")
    one = stored(verify(first, sequence, similarity), "copies-links")
    comp = stored(components(one.select(F.col("a").alias("u"), F.col("b").alias("v"))), "copies-components")
    # Where a bucket is not connected, what is apart meets the other members.
    known = _with_component(bucket, comp)
    lead = comp.select(F.col("node").alias("leader"), F.col("component").alias("_lead"))
    known = stored(lookup(known, lead, ["leader"], "left")
                   .withColumn("_lead", F.coalesce("_lead", "leader")), "copies-known")
    torn = known.filter("component <> _lead").select("key").distinct()
    some = stored(known.join(torn.hint("shuffle_merge"), "key", "left_semi"), "copies-some")
    least = (F.col("n") + F.col("n2")) * (similarity / (1 + similarity)) - 1e-6
    met = _across(some.filter(F.col("size") <= SMALL_BUCKET))
    large = some.filter(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        met = met.unionByName(_across_large(large, sequence, similarity, least))
    met = met.filter(_alike_in_length(similarity)).select("a", "b").distinct()
    two = stored(verify(stored(met, "copies-pairs"), sequence, similarity), "copies-links")
    return one.unionByName(two)


def _with_component(bucket: DataFrame, comp: DataFrame) -> DataFrame:
    return (bucket.join(comp.select(F.col("node").alias("rep"), "component").hint("shuffle_merge"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep")))


def _digest(words: np.ndarray, doc: int) -> bytes:
    return hashlib.blake2b(words.tobytes() if len(words) else b"%d" % doc, digest_size=16).digest()


@F.pandas_udf(BinaryType())
def digest_of(doc: pd.Series, text: pd.Series) -> pd.Series:
    cache = _Words()
    return pd.Series([_digest(word_hashes(t, cache), d) for d, t in zip(doc, text)], dtype=object)


def _classes(docs: DataFrame, drawn: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, digest, class_id) where an id has one text."""
    reps = stored(drawn.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"),
                                              F.first("keys").alias("keys"), F.first("short").alias("short")), "copies-reps")
    found = links(reps.filter("n > 0"), docs, similarity)
    comp = components(found.select(F.col("a").alias("u"), F.col("b").alias("v")))
    to = (reps.select("digest", "rep").join(comp.select(F.col("node").alias("rep"), "component")
                                                  .hint("shuffle_merge"), "rep", "left")
          .select("digest", F.coalesce("component", "rep").alias("class_id")))
    return (lookup(drawn.select("doc_id", "digest"), to, ["digest"])
            .select("doc_id", "digest", "class_id").distinct())


def _by_text(docs: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, digest, class_id) for every id and each text that rows of it have;
    the class of a text is the smallest id on rows with a text of the class."""
    small_text_batches(docs.sparkSession)
    drawn = stored(sketches(docs, similarity), "copies-sketches")
    low, high = F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high")
    if drawn.groupBy("doc_id").agg(low, high).filter("low <> high").isEmpty():
        return _classes(docs, drawn, similarity)
    # Some id has several texts: each (id, text) goes by a number of its own.
    own = stored(drawn.select("doc_id", "digest").distinct().withColumn("own", F.monotonically_increasing_id()), "copies-own")
    keys = ["doc_id", "digest"]
    texts = docs.filter("doc_id is not null").select("doc_id", "text", digest_of("doc_id", "text").alias("digest"))
    numbered = stored(texts.join(own, keys).select(F.col("own").alias("doc_id"), "text"), "copies-numbered")
    found = stored(_classes(numbered, drawn.join(own, keys).drop("doc_id").withColumnRenamed("own", "doc_id"), similarity)
                   .select(F.col("doc_id").alias("own"), "class_id"), "copies-own-classes")
    rows = own.join(found, "own")
    first = rows.groupBy("class_id").agg(F.min("doc_id").alias("_first"))
    return rows.join(first, "class_id").select("doc_id", "digest", F.col("_first").alias("class_id"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id): smallest id of the class, for every id of ``docs``."""
    return _by_text(docs, similarity).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose text stands in its class under the smallest id,
    and those without id. So every class keeps a row, whatever else its id is on."""
    by = stored(_by_text(docs, similarity), "copies-classes")
    gone = by.filter("class_id <> doc_id").select(F.col("doc_id").alias("_gone"), F.col("digest").alias("_digest"))
    held = by.filter("class_id = doc_id").select("doc_id")
    whole = stored(gone.join(held, F.col("_gone") == F.col("doc_id"), "left_anti").select("_gone").distinct(), "copies-gone")
    rows = packed(docs, "doc_id", "text")
    rows = rows.join(whole.hint("shuffle_merge"), F.col("doc_id") == F.col("_gone"), "left_anti")
    some = stored(gone.join(held, F.col("_gone") == F.col("doc_id"), "left_semi"), "copies-partly")
    if not some.isEmpty():
        # Ids with one text that stays and another that goes.
        mixed = some.select(F.col("_gone").alias("_id")).distinct()
        apart = rows.join(mixed, F.col("doc_id") == F.col("_id"), "left_semi")
        stay = apart.withColumn("_d", digest_of("doc_id", "text")).join(
            some, (F.col("doc_id") == F.col("_gone")) & (F.col("_d") == F.col("_digest")), "left_anti").select("_row", "doc_id", "text")
        rows = rows.join(mixed, F.col("doc_id") == F.col("_id"), "left_anti").unionByName(stay)
    return unpacked(rows)


def op10_order_minhash(spark, sf_dir):
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))
