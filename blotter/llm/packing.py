"""Operator 7: packing by optimal length buckets.

Documents are cut into pieces of at most ``MAX_TOKENS`` tokens (words); a piece
carries its words, joined by one space. The histogram of piece lengths has at most
``MAX_TOKENS`` + 1 entries whatever the input; dynamic programming over it chooses
the bucket boundaries that waste the fewest padding tokens. Inside each bucket the
pieces are numbered without gaps and cut into batches of at most ``BUDGET`` padded
tokens, so all batches of a bucket but its last are full.

Numbering holds no bucket together: pieces go to shards of some ``SHARD_ROWS``
rows by a hash of id, piece number and words, shards are numbered on their own, and
each shard starts where the pieces of the shards before it end. The pieces' words
are exchanged once, to their shard.

Defined cases: a null or empty text is one piece of 0 tokens and no words; rows that
repeat an id are packed each, and rows without an id are spread by their words (rows
equal in id and words share a shard); an empty table gives no rows; other columns
pass through ``pack`` unless they have the names it adds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, stored, table

MAX_TOKENS = 2048
BUCKETS = 8
#: Padded tokens in a batch.
BUDGET = 32_768
SHARD_ROWS = 5_000


#: A token.
WORD = "[^ \\t-\\r]+"


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row (doc_id, piece, first_token, n_tokens, text) per piece of a document."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))

    def cut(w: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil(F.size(w) / max_tokens) - 1).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: let(F.slice(w, i * max_tokens + 1, max_tokens), lambda own: F.struct(
            i.cast("long").alias("piece"), (i.cast("long") * max_tokens).alias("first_token"),
            F.size(own).cast("long").alias("n_tokens"), F.array_join(own, " ").alias("text"))))

    return docs.select("doc_id", F.explode(let(words, cut)).alias("_p")).select("doc_id", "_p.*")


def boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bucket bounds (at most ``buckets``) with the least total padding.

    best[k][j]: least padding of the j shortest lengths in k buckets. Among
    equal solutions the fewest buckets win, then the later cut."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    count = np.array([histogram[int(x)] for x in lengths], dtype=np.float64)
    rows = np.concatenate(([0.0], np.cumsum(count)))
    held = np.concatenate(([0.0], np.cumsum(count * lengths)))
    n = len(lengths)
    best, cuts = np.full(n + 1, np.inf), []
    best[0] = 0.0
    solutions = []
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (held[j] - held[:j])
            i = j - 1 - int(np.argmin(cost[::-1]))
            new[j], cut[j] = cost[i], i
        cuts.append(cut)
        best = new
        solutions.append(best[n])
    k, j, bounds = int(np.argmin(solutions)), n, []
    while k >= 0:
        bounds.append(int(lengths[j - 1]))
        j, k = int(cuts[k][j]), k - 1
    return bounds[::-1]


def pack(rows: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``rows`` (doc_id, piece, n_tokens, text, ...) with bucket_len, batch_no, slot."""
    histogram = {int(r.n_tokens): int(r.n) for r in
                 rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = boundaries(histogram, buckets) or [0]
    shards = max(1, sum(histogram.values()) // shard_rows)
    at = F.array(*[F.lit(b).cast("long") for b in bounds])
    keyed = (rows.withColumn("bucket_len", F.element_at(F.filter(at, lambda b: b >= F.col("n_tokens")), 1))
             .withColumn("_h", F.conv(F.substring(F.md5(F.concat_ws("|", "doc_id", "piece", "text").cast("binary")), 1, 15), 16, 10)
                         .cast("long"))
             .withColumn("_shard", F.pmod("_h", F.lit(shards))))
    sizes = keyed.groupBy("bucket_len", "_shard").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("bucket_len").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket_len", "_shard", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    own = Window.partitionBy("bucket_len", "_shard").orderBy("_h", "doc_id", "piece", "n_tokens")
    numbered = keyed.withColumn("_own", F.row_number().over(own))
    each = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1))))
    rank = F.col("_before") + F.col("_own") - 1
    return (numbered.join(offsets, ["bucket_len", "_shard"])
            .select(*[F.col(c) for c in rows.columns], "bucket_len",
                    F.floor(rank / each).cast("long").alias("batch_no"), (rank % each).cast("long").alias("slot")))


def pack_documents(docs: DataFrame, max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, budget: int = BUDGET,
                   shard_rows: int = SHARD_ROWS) -> DataFrame:
    return pack(stored(pieces(docs, max_tokens), "pack-pieces"), buckets, budget, shard_rows)


def op7_length_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _oracle() -> str:
    steps = ["b0 AS (SELECT CAST(0 AS BIGINT) AS j, CAST(0 AS BIGINT) AS best, CAST(0 AS BIGINT) AS cut)"]
    for k in range(1, BUCKETS + 1):
        steps.append(f"""b{k} AS (SELECT j, m.c AS best, -m.i AS cut FROM (
  SELECT a.j, min({{'c': CAST(p.best + a.l * (a.r - x.r) - (a.s - x.s) AS BIGINT), 'i': -x.j}}) AS m
  FROM b{k - 1} p JOIN x ON x.j = p.j JOIN x a ON a.j > x.j GROUP BY a.j))""")
    every = " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS k, * FROM b{k}" for k in range(1, BUCKETS + 1))
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
e AS (SELECT doc_id, w, unnest(range(0, greatest(1, CAST(ceil(len(w) / {MAX_TOKENS}.0) AS BIGINT)))) AS i FROM w),
p AS (SELECT doc_id, i AS piece, i * {MAX_TOKENS} AS first_token,
  CAST(greatest(0, least({MAX_TOKENS}, len(w) - i * {MAX_TOKENS})) AS BIGINT) AS n_tokens,
  coalesce(array_to_string(w[i * {MAX_TOKENS} + 1:(i + 1) * {MAX_TOKENS}], ' '), '') AS text FROM e),
h AS (SELECT n_tokens AS l, count(*) AS c FROM p GROUP BY n_tokens),
x AS (SELECT row_number() OVER (ORDER BY l) AS j, l, CAST(sum(c) OVER (ORDER BY l) AS BIGINT) AS r,
    CAST(sum(c * l) OVER (ORDER BY l) AS BIGINT) AS s FROM h UNION ALL SELECT 0, 0, 0, 0),
{", ".join(steps)},
t AS ({every}),
chosen AS (SELECT k, j, cut FROM t WHERE j = (SELECT max(j) FROM x) ORDER BY best, k LIMIT 1),
back AS (SELECT k, j, cut FROM chosen UNION ALL SELECT t.k, t.j, t.cut FROM back JOIN t ON t.k = back.k - 1 AND t.j = back.cut),
bounds AS (SELECT l FROM back JOIN x ON x.j = back.j),
of_piece AS (SELECT h.l, min(b.l) AS bucket_len FROM h JOIN bounds b ON b.l >= h.l GROUP BY h.l),
z AS (SELECT p.*, bucket_len, ('0x' || substr(md5(concat_ws('|', doc_id, piece, text)), 1, 15))::BIGINT AS z
    FROM p JOIN of_piece o ON o.l = p.n_tokens),
n AS (SELECT *, row_number() OVER (PARTITION BY bucket_len ORDER BY
    z % (SELECT greatest(1, count(*) // {SHARD_ROWS}) FROM p), z, doc_id NULLS FIRST, piece, n_tokens) - 1 AS rank FROM z)
SELECT doc_id, piece, first_token, n_tokens, text, CAST(bucket_len AS BIGINT) AS bucket_len,
  CAST(rank // greatest(1, {BUDGET} // greatest(bucket_len, 1)) AS BIGINT) AS batch_no,
  CAST(rank % greatest(1, {BUDGET} // greatest(bucket_len, 1)) AS BIGINT) AS slot
FROM n
"""


ORACLE_SQL = _oracle()
