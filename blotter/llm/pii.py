"""Operator 13: personal data by bootstrapped contextual extraction (native).

The base rules find emails, addresses, card and phone numbers; those are the
seeds. Every other mention that looks like an identifier (it has a digit or an
``@`` and does not overlap a seed) is a candidate. The lexical pattern of a
mention is the one or two words before it. Patterns and instances form a
graph, which Spark scores in ``ROUNDS`` rounds, for each kind of seed:

* a pattern that stands before at least ``SUPPORT`` believed instances has as
  confidence the mean score of all its instances, weak ones (such as bare
  numbers) included;
* an instance that is no seed has as score the confidence of its best pattern;
  seeds keep the full score. So instances that confident patterns discover come
  to support further patterns.

Patterns of at least ``ACCEPT`` then extract: candidates behind them whose shape
fits the kind are added, as ``like_<kind>``. Scores are integers (thousandths),
so any order of summing gives the same result. Each text is read once; only
spans, two words before each and hashes of values go on. DataFrame functions
only.

The base expressions are the given ones, written so that no text makes them
repeat work: possessive where nothing shorter can match, and started only
where the leftmost match can start.

Defined cases: a null text is empty; documents without mentions have counts of
0, no spans and the hash of no bytes; rows that repeat an id are documents of
their own, each with its spans; a word before a mention counts as far as it
lies in the ``REACH`` characters before it; a mention without words before it
has no pattern. Other columns are ignored. A value counts once per pattern
however often it is repeated, so copies of a document add no support.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, matches, small_text_batches, stored, table

ROUNDS = 3
FULL = 1000
#: Score from which an instance counts as believed.
BELIEVED = 500
SUPPORT = 5
ACCEPT = 800
#: Characters before a mention in which its words are looked for.
REACH = 100
_SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Kind:
    name: str
    #: The given expression, and the same matches for Java's engine.
    given: str
    regex: str


_LOCAL, _IN = "A-Za-z0-9._%+-", "A-Za-z0-9@._%+()/#-"
# The base kinds in the order in which they are listed.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9]){15,}+"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
# Mentions that look like identifiers, with further groups of digits.
_MORE = r"\x20[(]?[0-9][0-9()./-]*"
MENTION = Kind("", rf"[A-Za-z._%+()/#-]*[0-9@][{_IN}]*(?:{_MORE})*",
               rf"(?:\G|(?<![{_IN}]))[A-Za-z._%+()/#-]*+[0-9@][{_IN}]*+(?:{_MORE}+)*+")
_LEAD, _TAIL = "().%/_#-", "().%/_#+@-"
_PART = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_IP = rf"^{_PART}(\.{_PART}){{3}}$"
_OTHER = len(KINDS)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", _digits(value))
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _fits(kind: str, value: Column) -> Column:
    """Whether a candidate has the shape of ``kind``."""
    n, letters = F.length(_digits(value)), value.rlike("[A-Za-z]")
    if kind == "email":
        return value.rlike("[A-Za-z0-9]@[A-Za-z0-9]")
    if kind == "ip":
        return value.rlike("[0-9][.:][0-9]") & ~letters & (n >= 4)
    return n.between(12, 19) & ~letters if kind == "card" else n.between(7, 15) & ~letters


def pattern(before: Column, first: Column) -> Column:
    """The last words, at most two, of the text before a mention; mentions among them are ``#``."""
    near = F.right(F.concat(F.when(first, "").otherwise("# "), before), F.lit(REACH))
    plain = F.regexp_replace(F.lower(near), rf"[^{_SPACE}]*[0-9@][^{_SPACE}]*", "#")
    words = F.regexp_extract_all(plain, F.lit(rf"[^{_SPACE}]+"), F.lit(0))
    return let(words, lambda w: F.array_join(F.when(F.size(w) > 2, F.slice(w, -2, 2)).otherwise(w), " "))


_MENTIONS = "array<struct<kind:int,start:int,end:int,pattern:string,key:string,fits:int>>"


def _mention(kind: int, x: Column, i: Column) -> Column:
    """A match as a mention; for candidates, without the punctuation around it."""
    if kind < _OTHER:
        value, start, end, fits = x["value"], x["start"], x["end"], F.lit(0)
    else:
        cut = F.ltrim(x["value"], F.lit(_LEAD))
        start = x["end"] - F.length(cut)
        value = F.rtrim(cut, F.lit(_TAIL))
        end = start + F.length(value)
        fits = sum((F.when(_fits(k.name, value), 1 << n).otherwise(0) for n, k in enumerate(KINDS)), F.lit(0))
    key = F.md5(F.lower(F.regexp_replace(value, "[^A-Za-z0-9@]", "")))
    return F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                    pattern(x["before"], i == 0).alias("pattern"), key.alias("key"), fits.alias("fits"))


def mentions(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, m): the valid base matches by kind and
    start, then the candidates, overlapping or not."""
    text = F.coalesce("text", F.lit(""))

    def of(n: int, k: Kind) -> Column:
        def counts(y: Column) -> Column:
            value = y["x"]["value"]
            return _valid(k.name, value) if n < _OTHER else F.rtrim(F.ltrim(value, F.lit(_LEAD)), F.lit(_TAIL)) != ""

        found = F.transform(matches(text, k.regex), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        made = F.transform(F.filter(found, counts), lambda y: _mention(n, y["x"], y["i"])).cast(_MENTIONS)
        return F.when(text.rlike(k.regex), made).otherwise(F.array().cast(_MENTIONS))

    return docs.select("doc_id", F.concat(*[of(n, k) for n, k in enumerate((*KINDS, MENTION))]).alias("m"))


def free_mentions(found: DataFrame) -> DataFrame:
    """Rows (_row, kind, start, end, pattern, key, fits): all base matches, and the
    candidates that overlap none of them."""
    rows = found.filter(F.size("m") > 0).select("_row", F.explode("m").alias("x")).select("_row", "x.*")
    ahead = Window.partitionBy("_row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("_row").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") < _OTHER
    free = (F.coalesce(F.max(F.when(base, F.col("end"))).over(ahead) <= F.col("start"), F.lit(True))
            & F.coalesce(F.min(F.when(base, F.col("start"))).over(back) >= F.col("end"), F.lit(True)))
    return rows.withColumn("_free", base | free).filter("_free").drop("_free")


def learn(uses: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, accept: int = ACCEPT) -> DataFrame:
    """(pattern, kind, confidence) of the accepted patterns, one kind for each."""
    edge = uses.filter("pattern <> ''").select("pattern", "key").distinct()
    count = F.count(F.lit(1))
    # Patterns of fewer instances never reach the support.
    often = edge.groupBy("pattern").agg(count.alias("n")).filter(F.col("n") >= support)
    graph = stored(edge.join(often, "pattern"), "pii-graph")
    seed = stored(uses.filter(F.col("kind") < _OTHER).select("key", "kind").distinct()
                  .withColumn("score", F.lit(FULL).cast("long")), "pii-seeds")
    score = seed
    for i in range(rounds):
        believed = F.count_if(F.col("score") >= BELIEVED)
        sure = stored(graph.join(score, "key").groupBy("pattern", "kind")
                      .agg(F.sum("score").alias("s"), believed.alias("b"), F.max("n").alias("n")).filter(F.col("b") >= support)
                      .select("pattern", "kind", F.floor(F.col("s") / F.col("n")).alias("confidence")), "pii-patterns")
        if i < rounds - 1:
            found = graph.join(sure, "pattern").select("key", "kind", F.col("confidence").alias("score"))
            score = stored(found.unionByName(seed).groupBy("key", "kind").agg(F.max("score").alias("score")), "pii-scores")
    best = sure.filter(F.col("confidence") >= accept).groupBy("pattern").agg(
        F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("x"))
    return best.select("pattern", (-F.col("x.k")).alias("kind"), F.col("x.confidence").alias("confidence"))


def _listed(spans: Column) -> Column:
    """kind:start:end of the spans (kind, start, end); kinds from ``_OTHER`` on are learned ones."""
    names = F.array(*[F.lit(k.name) for k in KINDS], *[F.lit(f"like_{k.name}") for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


_SPANS = "array<struct<kind:int,start:int,end:int>>"


def find_personal(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, accept: int = ACCEPT) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, base, learned): arrays of spans (kind,
    start, end) by kind, then start; learned kinds count on from the base ones."""
    small_text_batches(docs.sparkSession)
    found = stored(mentions(docs).withColumn("_row", F.monotonically_increasing_id()), "pii-mentions")
    uses = stored(free_mentions(found), "pii-uses")
    sure = learn(uses, rounds, support, accept).select("pattern", F.col("kind").alias("k"))
    fits = F.expr("shiftright(fits, k) % 2") == 1
    new = (uses.filter("fits > 0").join(sure, "pattern").filter(fits).groupBy("_row")
           .agg(F.sort_array(F.collect_list(F.struct((F.col("k") + _OTHER).alias("kind"), "start", "end"))).alias("learned")))
    base = F.transform(F.filter("m", lambda x: x["kind"] < _OTHER), lambda x: F.struct(x["kind"], x["start"], x["end"]))
    rows = found.select("_row", "doc_id", base.cast(_SPANS).alias("base")).join(new, "_row", "left")
    return rows.select("doc_id", "base", F.coalesce("learned", F.array().cast(_SPANS)).alias("learned"))


def op13_pii_bootstrap(spark, sf_dir):
    rows = find_personal(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(n: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == n)).cast("long")

    return rows.select("doc_id", *[count(n).alias(f"n_{k.name}") for n, k in enumerate(KINDS)], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                       _listed(F.concat("base", "learned")).alias("spans"))


def _sql_valid(kind: str) -> str:
    digits = "regexp_replace(x.value, '[^0-9]', '', 'g')"
    if kind == "ip":
        return f"regexp_matches(x.value, '{_IP}')"
    if kind == "phone":
        return f"len({digits}) BETWEEN 8 AND 15"
    if kind != "card":
        return "true"
    return (f"len({digits}) BETWEEN 16 AND 19 AND list_sum(list_transform(string_split(reverse({digits}), ''), lambda c, i: "
            "CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN 2 * CAST(c AS INT) - 9 ELSE 2 * CAST(c AS INT) END)) % 10 = 0")


def _sql_fits() -> str:
    n, letters = "len(regexp_replace(value, '[^0-9]', '', 'g'))", "regexp_matches(value, '[A-Za-z]')"
    return (f"CAST(regexp_matches(value, '[A-Za-z0-9]@[A-Za-z0-9]') AS INT)"
            f" + 2 * CAST(regexp_matches(value, '[0-9][.:][0-9]') AND NOT {letters} AND {n} >= 4 AS INT)"
            f" + 4 * CAST({n} BETWEEN 12 AND 19 AND NOT {letters} AS INT) + 8 * CAST({n} BETWEEN 7 AND 15 AND NOT {letters} AS INT)")


def _sql_matches(n: int, k: Kind) -> str:
    rx = k.given.replace("'", "''")
    return f"""
g{n} AS (SELECT rn, string_split_regex(text, '{rx}') AS gap, regexp_extract_all(text, '{rx}') AS hit FROM d),
x{n} AS (SELECT rn, {n} AS kind, i, hit[i] AS value, gap[i] AS before,
    CAST(list_sum(list_transform(gap[1:i], lambda y: len(y))) + coalesce(list_sum(list_transform(hit[1:i - 1], lambda y: len(y))), 0) AS BIGINT) AS pos
  FROM g{n}, unnest(range(1, len(hit) + 1)) AS t(i)),
y{n} AS (SELECT rn, kind, i, before, {"value, pos" if n < _OTHER else f"rtrim(ltrim(value, '{_LEAD}'), '{_TAIL}') AS value, pos + len(value) - len(ltrim(value, '{_LEAD}')) AS pos"}
  FROM x{n} x WHERE {_sql_valid(k.name) if n < _OTHER else f"rtrim(ltrim(x.value, '{_LEAD}'), '{_TAIL}') <> ''"})"""


def _sql_round(i: int) -> str:
    pattern = f"""
p{i} AS MATERIALIZED (SELECT g.pattern, s.kind, sum(s.score) // max(g.n) AS confidence FROM graph g JOIN s{i} s ON g.key = s.key
  GROUP BY g.pattern, s.kind HAVING count(*) FILTER (WHERE s.score >= {BELIEVED}) >= {SUPPORT})"""
    if i == ROUNDS - 1:
        return pattern
    return pattern + f""",
s{i + 1} AS MATERIALIZED (SELECT key, kind, max(score) AS score FROM (
    SELECT g.key, p.kind, p.confidence AS score FROM graph g JOIN p{i} p ON g.pattern = p.pattern
    UNION ALL SELECT key, kind, score FROM s0) GROUP BY key, kind)"""


_ALL = (*KINDS, MENTION)
_NAMES = "[" + ", ".join(f"'{p}{k.name}'" for p in ("", "like_") for k in KINDS) + "]"
ORACLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
{",".join(_sql_matches(n, k) for n, k in enumerate(_ALL))},
a AS MATERIALIZED (SELECT rn, kind, pos AS start, pos + len(value) AS stop, value, {_sql_fits()} AS fits,
    md5(lower(regexp_replace(value, '[^A-Za-z0-9@]', '', 'g'))) AS key,
    array_to_string(regexp_extract_all(regexp_replace(lower(right(CASE WHEN i > 1 THEN '# ' ELSE '' END || before, {REACH})),
      '[^{_SPACE}]*[0-9@][^{_SPACE}]*', '#', 'g'), '[^{_SPACE}]+')[-2:], ' ') AS pattern
  FROM ({" UNION ALL ".join(f"SELECT * FROM y{n}" for n in range(len(_ALL)))})),
u AS MATERIALIZED (SELECT * FROM a WHERE kind < {_OTHER} OR NOT EXISTS (SELECT 1 FROM a b WHERE b.rn = a.rn AND b.kind < {_OTHER}
    AND b.start < a.stop AND b.stop > a.start)),
edge AS MATERIALIZED (SELECT DISTINCT pattern, key FROM u WHERE pattern <> ''),
graph AS MATERIALIZED (SELECT e.pattern, e.key, o.n FROM edge e
  JOIN (SELECT pattern, count(*) AS n FROM edge GROUP BY pattern HAVING count(*) >= {SUPPORT}) o ON e.pattern = o.pattern),
s0 AS MATERIALIZED (SELECT DISTINCT key, kind, {FULL} AS score FROM u WHERE kind < {_OTHER}),
{",".join(_sql_round(i) for i in range(ROUNDS))},
sure AS (SELECT pattern, kind FROM p{ROUNDS - 1} WHERE confidence >= {ACCEPT}
  QUALIFY row_number() OVER (PARTITION BY pattern ORDER BY confidence DESC, kind) = 1),
l AS (SELECT u.rn, sure.kind + {_OTHER} AS kind, u.start, u.stop FROM u JOIN sure ON u.pattern = sure.pattern
  WHERE u.kind = {_OTHER} AND (u.fits >> sure.kind) % 2 = 1),
f AS (SELECT rn, kind, start, stop, {_NAMES}[kind + 1] || ':' || start || ':' || stop AS s
  FROM (SELECT rn, kind, start, stop FROM u WHERE kind < {_OTHER} UNION ALL SELECT * FROM l)),
o AS (SELECT rn, {", ".join(f"count(*) FILTER (WHERE kind = {n}) AS n_{k.name}" for n, k in enumerate(KINDS))},
    string_agg(s, ',' ORDER BY kind, start) FILTER (WHERE kind < {_OTHER}) AS base, string_agg(s, ',' ORDER BY kind, start) AS spans
  FROM f GROUP BY rn)
SELECT d.doc_id, {", ".join(f"coalesce(o.n_{k.name}, 0) AS n_{k.name}" for k in KINDS)},
  sha256(coalesce(o.base, '')) AS base_sha256, coalesce(o.spans, '') AS spans
FROM d LEFT JOIN o ON d.rn = o.rn
"""
