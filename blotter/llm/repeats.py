"""Operator 6: repeated byte strings by a distributed merge sort of suffixes.

Every ``WINDOW``-byte string has an anchor: the position of its smallest
``GRAM``-byte hash (leftmost if equal). Equal strings have the same anchor, so
sorting the suffixes that start at anchors, each with the bytes before it,
brings all equal strings together; consecutive strings with one anchor form
one record of at most ``_RECORD`` bytes. The steps:

1. Texts are gathered into blocks of some ``BLOCK_BYTES``. Each block sends the
   hashes of its anchors to hash ranges, which answer which of them occur in
   other documents too (prefixes that nobody shares need no sorting).
2. Each block sorts its remaining records and sends one front-coded run (shared
   prefix length and rest of each record) per hash range.
3. A hash range merges its runs by a loser tree that carries the known common
   prefixes (in 8-byte words): unequal prefix lengths decide a match without a
   look at the records, and equal ones are compared from there on. The order is that
   of (hash range, bytes), in which equal prefixes stand together.
4. Intervals of the merged order, by common prefix length, give each string of
   each record the smallest document it occurs in. Answers return to the
   blocks, which mark the bytes and hash what is left.

A hash range gets one copy of a record per block however often it occurs there,
so hot passages stay small. Strings are compared whole; hashes only choose
anchors and partners.

Defined cases: null and empty texts have no byte; a null id counts as larger
than every other; rows that repeat an id do not remove each other's bytes;
texts of any length are worked through in steps of ``_STEP`` bytes; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_text_batches, table

WINDOW = 50
GRAM = 16
BLOCK_BYTES = 4 << 20
#: Bytes of text per hash range (one anchor per 18 bytes on average).
RANGE_BYTES = 4 << 20
_STEP = (1 << 16) - 64
_PLACE = np.uint64(0xFFFF)
_LEFT = WINDOW - GRAM
#: Right part, its length, left part reversed, its length + 1.
_RECORD = WINDOW + 1 + _LEFT + 1
_LAST = np.int64(2 ** 63 - 1)
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def _hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position of ``buf`` (uint8)."""
    n = len(buf) - GRAM + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    padded = np.concatenate((buf, np.zeros(16, dtype=np.uint8)))
    word = np.empty(len(buf) + 8, dtype=np.uint64)
    for o in range(8):
        part = padded[o:o + (len(padded) - o) // 8 * 8].view(np.uint64)
        word[o::8] = part[:len(word[o::8])]
    h = word[:n] * _A
    for o in range(8, GRAM, 8):
        h = (h ^ (h >> np.uint64(31))) * _B + word[o:o + n]
    h ^= h >> np.uint64(32)
    h *= _C
    h ^= h >> np.uint64(29)
    return h


def _anchors_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor position of the string at each start, hash at each position); the
    position stands in the low bits of what is minimised, so the left one of
    equal hashes wins."""
    h = _hashes(buf)
    least = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span, width = 1, WINDOW - GRAM + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        span += step
    return (least & _PLACE).astype(np.int64), h


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Records of the texts buf[starts:ends]: (anchor, first and last string
    start, hash, text number), strings of one text with one anchor together."""
    # Strings must end within their text: the last starts of each are barred.
    barred = np.zeros(len(buf) + 1, dtype=np.int32)
    np.add.at(barred, np.maximum(starts, ends - WINDOW + 1), 1)
    np.add.at(barred, ends, -1)
    open_ = np.cumsum(barred[:-1]) == 0
    parts = []
    for lo in range(0, len(buf), _STEP):
        at, h = _anchors_of(buf[lo:min(len(buf), lo + _STEP + WINDOW - 1)])
        place = np.flatnonzero(open_[lo:lo + min(_STEP, len(at))])
        if not len(place):
            continue
        at = at[place]
        # An anchor lies in its string's own text, so texts never share one.
        new = np.concatenate(([True], (at[1:] != at[:-1]) | (place[1:] != place[:-1] + 1)))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place)) - 1
        parts.append((at[first] + lo, place[first] + lo, place[last] + lo, h[at[first]]))
    if not parts:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z.astype(np.uint64), z
    p, s, e, h = (np.concatenate(x) for x in zip(*parts))
    # Hashes of anchors are small ones; mixed again they spread evenly.
    h = (h ^ (h >> np.uint64(33))) * _A
    h = (h ^ (h >> np.uint64(29))) * _C
    return p, s, e, h ^ (h >> np.uint64(32)), np.searchsorted(starts, p, side="right") - 1


def _range_of(h: np.ndarray, ranges: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _short(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(0xFFFFFFFE)).astype(np.uint32)


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([x.nbytes for x in arrays], dtype=np.int64).tobytes()
    return head + b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def _unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    size = np.frombuffer(raw, np.int64, len(kinds))
    at = 8 * len(kinds) + np.concatenate(([0], np.cumsum(size)))
    return [np.frombuffer(raw[a:a + n], k) for a, n, k in zip(at, size, kinds)]


def gather(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, texts): ids, sizes and bytes of some documents of the block."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            out = []
            for block, f in b.groupby("block"):
                raw = [b"" if t is None else t.encode() for t in f.text]
                known = f.doc_id.notna().to_numpy()
                ids = f.doc_id.fillna(0).to_numpy().astype(np.int64)
                out.append((block, z.compress(_pack(ids, known, np.array([len(x) for x in raw], dtype=np.int64),
                                                    np.frombuffer(b"".join(raw), np.uint8)))))
            yield pd.DataFrame(out, columns=["block", "texts"])

    # Row by row ids as strings would lose nothing but nulls turn longs to floats.
    rows = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"), "doc_id", "text")
    known = rows.filter("doc_id is not null").mapInPandas(work, "block long, texts binary")
    return known.unionByName(rows.filter("doc_id is null").withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
                             .mapInPandas(work, "block long, texts binary"))


class Block:
    """The texts of a block in a fixed order (id, then bytes)."""

    def __init__(self, blobs):
        d = zstandard.ZstdDecompressor()
        ids, known, texts = [], [], []
        for blob in blobs:
            i, k, n, raw = _unpack(d.decompress(blob), np.int64, bool, np.int64, np.uint8)
            cut = np.concatenate(([0], np.cumsum(n)))
            data = raw.tobytes()
            ids += i.tolist()
            known += k.tolist()
            texts += [data[a:b] for a, b in zip(cut[:-1], cut[1:])]
        order = sorted(range(len(ids)), key=lambda j: (not known[j], ids[j], texts[j]))
        self.known = np.array([known[j] for j in order], dtype=bool)
        self.ids = np.array([ids[j] for j in order], dtype=np.int64)
        self.rank = np.where(self.known, self.ids, _LAST)
        size = np.array([len(texts[j]) for j in order], dtype=np.int64)
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.buf = np.frombuffer(b"".join(texts[j] for j in order), np.uint8)


def send_hashes(block: Block, ranges: int) -> list[tuple[int, bytes]]:
    """(hash range, sorted 31-bit hashes; the lowest bit: several documents here)."""
    _, _, _, h, doc = anchors(block.buf, block.starts, block.ends)
    if not len(h):
        return []
    rank, out = block.rank[doc], []
    key = (_range_of(h, ranges).astype(np.uint64) << np.uint64(32)) | _short(h)
    order = np.argsort(key, kind="stable")
    key, rank = key[order], rank[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    several = np.minimum.reduceat(rank, first) != np.maximum.reduceat(rank, first)
    key = key[first] | several.astype(np.uint64)
    where = (key >> np.uint64(32)).astype(np.int64)
    for r, part in zip(*_split(where, key.astype(np.uint32))):
        out.append((r, part.tobytes()))
    return out


def _split(where: np.ndarray, *arrays):
    """Distinct values of the sorted ``where`` and the slices of each array."""
    value, first = np.unique(where, return_index=True)
    cut = np.append(first, len(where))
    slices = [[x[a:b] for a, b in zip(cut[:-1], cut[1:])] for x in arrays]
    return [value.tolist(), *slices]


def shared_hashes(blocks: list[int], blobs: list[bytes]) -> list[tuple[int, bytes]]:
    """Of each block's hashes those that another document has too."""
    each = [np.frombuffer(b, np.uint32) for b in blobs]
    whole = np.concatenate(each) if each else np.zeros(0, np.uint32)
    bare = np.sort(whole & np.uint32(0xFFFFFFFE))
    twice = np.unique(np.concatenate((bare[1:][bare[1:] == bare[:-1]], (whole & np.uint32(0xFFFFFFFE))[(whole & 1) == 1])))
    out = []
    for block, x in zip(blocks, each):
        x = x & np.uint32(0xFFFFFFFE)
        at = np.minimum(np.searchsorted(twice, x), max(len(twice) - 1, 0))
        hit = x[twice[at] == x] if len(twice) else x[:0]
        if len(hit):
            out.append((block, hit.tobytes()))
    return out


def _records(buf, p, s, e) -> np.ndarray:
    """Fixed-width sortable records: suffix at the anchor, bytes before it reversed."""
    n = len(p)
    padded = np.concatenate((buf, np.zeros(WINDOW, dtype=np.uint8)))
    rec = np.zeros((n, _RECORD), dtype=np.uint8)
    right, left = e + WINDOW - p, p - s
    for i in range(WINDOW):
        rec[:, i] = np.where(i < right, padded[p + i], 0)
    rec[:, WINDOW] = right
    for i in range(_LEFT):
        rec[:, WINDOW + 1 + i] = np.where(i < left, padded[p - 1 - i], 0)
    rec[:, -1] = left + 1
    return rec


def front_code(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared prefix length with the record before, and the rests one after another."""
    if not len(rec):
        return np.zeros(0, np.uint8), np.zeros(0, np.uint8)
    lcp = np.concatenate(([0], (rec[1:] != rec[:-1]).argmax(axis=1)))
    return lcp.astype(np.uint8), rec[np.arange(_RECORD)[None, :] >= lcp[:, None]]


def front_decode(lcp: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The records again: each byte that a record shares comes from the last
    record before it that did not."""
    n = len(lcp)
    rec = np.zeros((n, _RECORD), dtype=np.uint8)
    own = np.arange(_RECORD)[None, :] >= lcp[:, None]
    rec[own] = rest
    row = np.arange(n)
    for i in range(_RECORD):
        rec[:, i] = rec[np.maximum.accumulate(np.where(own[:, i], row, 0)), i]
    return rec


def sorted_records(block: Block, ranges: int, wanted: dict[int, np.ndarray]) -> Iterator[tuple]:
    """Per hash range: the sorted distinct records of the block's wanted anchors
    (entries), and of every place its entry, text and anchor."""
    p, s, e, h, doc = anchors(block.buf, block.starts, block.ends)
    where, short, keep = _range_of(h, ranges), _short(h), np.zeros(len(h), dtype=bool)
    order = np.argsort(where, kind="stable")
    for r, rows in zip(*_split(where[order], order)):
        if (want := wanted.get(r)) is not None and len(want):
            at = np.minimum(np.searchsorted(want, short[rows]), len(want) - 1)
            keep[rows] = want[at] == short[rows]
    rows = order[keep[order]]
    if not len(rows):
        return
    rec = _records(block.buf, p[rows], s[rows], e[rows])
    by = np.argsort(rec.view(f"S{_RECORD}").ravel(), kind="stable")
    by = by[np.argsort(where[rows][by], kind="stable")]
    for r, rec, mine in zip(*_split(where[rows[by]], rec[by], rows[by])):
        new = np.concatenate(([True], (rec[1:] != rec[:-1]).any(axis=1)))
        yield r, rec[new], np.cumsum(new) - 1, doc[mine], p[mine]


def send_runs(block: Block, ranges: int, wanted: dict[int, np.ndarray]) -> list[tuple[int, bytes]]:
    """(hash range, front-coded run of the entries with the smallest and largest
    document that holds each)."""
    z, out = zstandard.ZstdCompressor(level=1), []
    for r, rec, entry, doc, _ in sorted_records(block, ranges, wanted):
        rank = block.rank[doc]
        first = np.searchsorted(entry, np.arange(len(rec)))
        lcp, rest = front_code(rec)
        out.append((r, z.compress(_pack(lcp, rest, np.minimum.reduceat(rank, first), np.maximum.reduceat(rank, first)))))
    return out


def merge_runs(runs: list[np.ndarray], shared: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Loser tree over sorted runs: (run, entry) in merged order.

    Records are compared by 8-byte words. Each waiting record knows how many
    words it has in common with the last record put out (``shared``: with the
    record before it in its own run); of two, the one with more in common goes
    first unseen, and with as many the comparison starts after them."""
    live = [i for i, r in enumerate(runs) if len(r)]
    total = sum(len(runs[i]) for i in live)
    source, entry = np.empty(total, np.int32), np.empty(total, np.int32)
    if not live:
        return source, entry
    size = 1
    while size < len(live):
        size *= 2
    pad = -_RECORD % 8
    words = [np.pad(runs[i], ((0, 0), (0, pad))).view(">u8").tolist() for i in live]
    same = [(shared[i] // 8).tolist() for i in live]
    width = (_RECORD + pad) // 8
    # -1 in common marks a run at its end: it loses against every record.
    head = [w[0] for w in words] + [None] * (size - len(live))
    known, at = [0] * len(live) + [-1] * (size - len(live)), [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        m, n = known[a], known[b]
        if m != n:
            return (a, b) if m > n else (b, a)
        if m < 0:
            return a, b
        x, y = head[a], head[b]
        while m < width and x[m] == y[m]:
            m += 1
        if m == width or x[m] < y[m]:
            known[b] = m
            return a, b
        known[a] = m
        return b, a

    tree, winner = [0] * size, list(range(size))
    while len(winner) > 1:
        level = len(winner) // 2
        pairs = [play(winner[2 * i], winner[2 * i + 1]) for i in range(level)]
        tree[level:2 * level] = [lose for _, lose in pairs]
        winner = [win for win, _ in pairs]
    top = winner[0]
    for k in range(total):
        i = at[top]
        source[k], entry[k] = live[top], i
        at[top] = i = i + 1
        if i < len(words[top]):
            head[top], known[top] = words[top][i], same[top][i]
        else:
            known[top] = -1
        node = (size + top) >> 1
        while node:
            other = tree[node]
            m, n = known[top], known[other]
            if m < n:
                top, tree[node] = other, top
            elif m == n and m >= 0:
                top, tree[node] = play(top, other)
            node >>= 1
    return source, entry


def smallest_holder(rec: np.ndarray, lcp: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For sorted distinct records: the smallest document that holds the string
    with l bytes before the anchor, per record and l (_LAST where there is none).

    Two records hold the same string if they share its bytes from the anchor on
    (an interval of the order, by ``lcp``) and those before it."""
    n = len(rec)
    right, left = rec[:, WINDOW].astype(np.int64), rec[:, -1].astype(np.int64) - 1
    out = np.full((n, _LEFT + 1), _LAST)
    before = np.ascontiguousarray(rec[:, WINDOW + 1:WINDOW + 1 + _LEFT])
    by = np.argsort(before.view(f"S{_LEFT}").ravel(), kind="stable")
    differ = before[by][1:] != before[by][:-1]
    shared = np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), _LEFT))) if n else np.zeros(0)
    for l in range(_LEFT + 1):
        has = np.flatnonzero((left >= l) & (right >= WINDOW - l))
        if not len(has):
            continue
        a = np.cumsum(lcp < WINDOW - l)
        b = np.empty(n, dtype=np.int64)
        b[by] = np.cumsum(shared < l)
        key = a[has] * np.int64(n + 1) + b[has]
        order = np.argsort(key, kind="stable")
        key, rows = key[order], has[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        least = np.minimum.reduceat(low[rows], first)
        out[rows, l] = np.repeat(least, np.diff(np.append(first, len(rows))))
    return out


def resolve(blocks: list[int], blobs: list[bytes]) -> list[tuple[int, bytes]]:
    """Merge the runs of a hash range; answer each block with (entry, first and
    last l, smallest holder) where that precedes a document of the entry."""
    runs, shared, lows, highs = [], [], [], []
    z = zstandard.ZstdDecompressor()
    for blob in blobs:
        lcp, rest, low, high = _unpack(z.decompress(blob), np.uint8, np.uint8, np.int64, np.int64)
        runs.append(front_decode(lcp, rest))
        shared.append(lcp)
        lows.append(low)
        highs.append(high)
    source, entry = merge_runs(runs, shared)
    if not len(source):
        return []
    start = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
    place = start[source] + entry
    whole = np.concatenate(runs)[place]
    low, high = np.concatenate(lows)[place], np.concatenate(highs)[place]
    del runs
    differ = whole[1:] != whole[:-1]
    common = np.concatenate(([0], np.where(differ.any(axis=1), differ.argmax(axis=1), _RECORD)))
    first = np.flatnonzero(common < _RECORD)
    distinct = np.cumsum(common < _RECORD) - 1
    rec = whole[first]
    del whole, differ
    holder = smallest_holder(rec, np.minimum(common[first], WINDOW), np.minimum.reduceat(low, first))
    out = []
    by = np.argsort(source, kind="stable")
    for i, rows in zip(*_split(source[by], by)):
        h = holder[distinct[rows]]
        r, l = np.nonzero(h < high[rows][:, None])
        if not len(r):
            continue
        v = h[r, l]
        new = np.concatenate(([True], (r[1:] != r[:-1]) | (l[1:] != l[:-1] + 1) | (v[1:] != v[:-1])))
        a = np.flatnonzero(new)
        z = np.append(a[1:], len(r)) - 1
        out.append((blocks[i], _pack(entry[rows][r[a]].astype(np.uint32), l[a].astype(np.uint8), l[z].astype(np.uint8), v[a])))
    return out


def mark(block: Block, ranges: int, wanted: dict[int, np.ndarray], answers: dict[int, bytes]) -> np.ndarray:
    """Which bytes of the block are to go."""
    delta = np.zeros(len(block.buf) + 1, dtype=np.int32)
    for r, _, of, doc, p in sorted_records(block, ranges, wanted) if answers else ():
        if r not in answers:
            continue
        entry, l0, l1, holder = _unpack(answers[r], np.uint32, np.uint8, np.uint8, np.int64)
        lo, hi = np.searchsorted(of, entry, "left"), np.searchsorted(of, entry, "right")
        k = np.repeat(np.arange(len(entry)), hi - lo)
        at = np.arange(len(k)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        gone = holder[k] < block.rank[doc[at]]
        k, at = k[gone], at[gone]
        np.add.at(delta, p[at] - l1[k], 1)
        np.add.at(delta, p[at] - l0[k] + WINDOW, -1)
    return np.cumsum(delta[:-1]) > 0


def spans(block: Block, gone: np.ndarray) -> pd.DataFrame:
    """Per document: bytes, removed bytes, removed runs, hash and bytes of the rest."""
    rows, data = [], block.buf.tobytes()
    for i, (a, b) in enumerate(zip(block.starts.tolist(), block.ends.tolist())):
        out = gone[a:b]
        left, n = data[a:b], int(out.sum())
        runs = int(out[0]) + int(np.count_nonzero(out[1:] & ~out[:-1])) if n else 0
        if n:
            left = block.buf[a:b][~out].tobytes()
        rows.append((block.ids[i] if block.known[i] else None, b - a, n, runs, hashlib.sha256(left).hexdigest(), left))
    return pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES,
                   with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row of ``docs``."""
    spark = docs.sparkSession
    small_text_batches(spark)
    own = docs.select("doc_id", "text")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks, ranges = max(least, -(-total // block_bytes)), max(least, -(-total // range_bytes))
    texts = gather(own, blocks)

    def hashes(f: pd.DataFrame) -> pd.DataFrame:
        got = send_hashes(Block(f.texts), ranges)
        return pd.DataFrame({"part": [r for r, _ in got], "block": f.block.iloc[0], "data": [b for _, b in got]})

    def shared(key, f: pd.DataFrame) -> pd.DataFrame:
        got = shared_hashes(f.block.tolist(), f.data.tolist())
        return pd.DataFrame({"block": [b for b, _ in got], "part": key[0], "data": [x for _, x in got]})

    def wanted(g: pd.DataFrame) -> dict[int, np.ndarray]:
        return {r: np.frombuffer(x, np.uint32) for r, x in zip(g.part, g.data)}

    def runs(f: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        got = send_runs(Block(f.texts), ranges, wanted(g)) if len(f) and len(g) else []
        return pd.DataFrame({"block": f.block.iloc[0] if len(f) else None, "part": [r for r, _ in got],
                             "run": [x for _, x in got]})

    def merged(key, f: pd.DataFrame) -> pd.DataFrame:
        got = resolve(f.block.tolist(), f.run.tolist())
        return pd.DataFrame({"block": [b for b, _ in got], "part": key[0], "answer": True, "data": [x for _, x in got]})

    def finish(f: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame({c: [] for c in columns})
        block, said = Block(f.texts), g[g.answer]
        gone = mark(block, ranges, wanted(g[~g.answer]), dict(zip(said.part, said.data)))
        return spans(block, gone).astype({"doc_id": "Int64"})[columns]

    # The texts are dealt to blocks once; all three steps read that exchange.
    known = (texts.groupBy("block").applyInPandas(hashes, "part long, block long, data binary")
             .groupBy("part").applyInPandas(shared, "block long, part long, data binary"))
    answers = (texts.groupBy("block").cogroup(known.groupBy("block"))
               .applyInPandas(runs, "block long, part long, run binary").groupBy("part")
               .applyInPandas(merged, "block long, part long, answer boolean, data binary"))
    back = answers.unionByName(known.withColumn("answer", F.lit(False)))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(finish, schema)


def op6_suffix_dedup(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS t, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - {WINDOW - 1})) AS i, t FROM d WHERE n >= {WINDOW}),
k AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(t, 2 * i + 1, {2 * WINDOW})) AS h FROM w),
f AS (SELECT h, min(doc_id) AS first_doc FROM k GROUP BY h),
g AS (SELECT doc_id, i FROM k JOIN f USING (h) WHERE first_doc < doc_id),
b AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last_i FROM g),
s AS (SELECT doc_id, i, sum(CASE WHEN last_i IS NULL OR i > last_i + {WINDOW} THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS run FROM b),
r AS (SELECT doc_id, run, min(i) AS a, max(i) + {WINDOW} AS z FROM s GROUP BY doc_id, run),
o AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
p AS (SELECT o.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last_z,
    string_agg(substr(t, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM o JOIN d ON o.doc_id = d.doc_id GROUP BY o.doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(t, 2 * coalesce(last_z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN p ON d.doc_id = p.doc_id
"""
