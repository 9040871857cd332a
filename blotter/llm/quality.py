"""Operator 8: quality rules by gradient-boosted trees over document statistics.

``statistics`` counts over whole texts in Arrow batches. A forest (see
``trees``) is fitted on at most ``TRAIN_ROWS`` labelled documents, chosen by a
hash of their id, with the margin falling in the junk shares (``MONOTONE``);
``judge`` scores every document in one narrow pass without a shuffle.

A document is kept unless the base rule fails or its predicted quality is
below ``LEAST_QUALITY``.

Defined cases: a null text has no word and fails the base rule; without labels
of both classes only the base rule decides; labels that repeat an id count by
their lowest quality; null labels are left out; ``filter_quality`` passes all
columns through, whatever their names (``judge`` replaces one named ``_q``).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, small_text_batches, table, unpacked
from .trees import Forest, fit

#: Bound of the labelled sample that is collected for training.
TRAIN_ROWS = 20_000
#: Predicted probability of good quality below which a document is rejected.
LEAST_QUALITY = 0.3
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbol_share", "upper_share", "digit_share", "dup_line_share",
            "repeat_share", "distinct_share", "line_words", "mark_share", "short_share")
#: Direction of the margin in these features.
MONOTONE = {FEATURES.index(n): -1 for n in ("symbol_share", "upper_share", "dup_line_share", "repeat_share", "mark_share")}
_COUNTS = [T.StructField(c, T.LongType()) for c in BASE]
_STATISTICS = T.StructType([*_COUNTS, *(T.StructField(c, T.DoubleType()) for c in FEATURES)])
_VERDICT = T.StructType([*_COUNTS, T.StructField("base_failed", T.BooleanType()),
                         T.StructField("quality", T.DoubleType()), T.StructField("kept", T.BooleanType())])
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_NOT_UPPER = re.compile(r"[^A-ZÄÖÜÀ-Þ]+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def repeated_words(words: list[str], size: int = 5) -> int:
    """Words inside windows of ``size`` words that occur twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    # Ranks of ever longer windows: exact, and never larger than the text.
    rank, span = ids, 1
    while span < size:
        step = min(span, size - span)
        wide = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        _, rank, count = np.unique(wide, return_inverse=True, return_counts=True)
        span += step
    hit = np.flatnonzero(count[rank] > 1)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + size, -1)
    return int(np.count_nonzero(np.cumsum(cover[:-1])))


def text_statistics(text: str | None) -> tuple:
    text = text or ""
    words = _WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = sum(text.count(c) for c in _SYMBOLS)
    lines, seen, dup, full = text.split("\n"), set(), 0, 0
    for line in lines:
        if _WORD.search(line):
            full += 1
            dup += line in seen
            seen.add(line)
    repeat = repeated_words(words)
    c, w = max(chars, 1), max(n, 1)
    marks = sum(map(text.count, "!?"))
    return (n, chars, symbols, dup, repeat, float(np.log1p(n)), chars / w, symbols / c,
            len(_NOT_UPPER.sub("", text)) / c, len(_NOT_DIGIT.sub("", text)) / c, dup / max(full, 1), repeat / w,
            len(set(words)) / w, n / max(full, 1), marks / c, sum(len(x) < 3 for x in words) / w)


@F.pandas_udf(_STATISTICS)
def statistics(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_statistics(t) for t in text], columns=[*BASE, *FEATURES])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Forest | None:
    """Forest for P(quality = 1), or None without both classes in the sample."""
    known = (labels.filter("doc_id is not null and quality is not null").groupBy("doc_id")
             .agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # Of rows that repeat an id, the text with the smallest hash counts.
    text = (docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
            .groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")))
    sample = (text.select("doc_id", "quality", statistics("t.text").alias("s"))
              .select("doc_id", "quality", *[F.col(f"s.{c}") for c in FEATURES]).collect())
    sample.sort(key=lambda r: r.doc_id)
    y = np.array([r.quality for r in sample], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    return fit(np.array([r[2:] for r in sample], dtype=float), y, MONOTONE)


def judge(docs: DataFrame, forest: Forest | None, least: float = LEAST_QUALITY) -> DataFrame:
    """``docs`` with struct ``_q``: the base counts, base_failed, quality, kept."""
    @F.pandas_udf(_VERDICT)
    def verdict(text: pd.Series) -> pd.DataFrame:
        s = pd.DataFrame([text_statistics(t) for t in text], columns=[*BASE, *FEATURES])
        out = s[list(BASE)].copy()
        out["base_failed"] = (s.n_words < MIN_WORDS) | (100 * s.n_repeat_words > MAX_REPEAT_PERCENT * s.n_words)
        out["quality"] = 1.0 if forest is None else forest.predict(s[list(FEATURES)].to_numpy(dtype=float))
        out["kept"] = ~out.base_failed & (out.quality >= least)
        return out

    return docs.withColumn("_q", verdict("text"))


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` with their own columns."""
    small_text_batches(docs.sparkSession)
    return unpacked(judge(packed(docs, "text"), train(docs, labels)).filter("_q.kept"))


def op8_quality_trees(spark, sf_dir):
    small_text_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = train(docs, table(spark, sf_dir, "labels"))
    return judge(docs, forest).select("doc_id", *[f"_q.{c}" for c in BASE], "_q.base_failed", "_q.kept")
