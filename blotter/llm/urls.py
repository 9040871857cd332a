"""Operator 4: URL filter by association rules and a host-path rule list.

FP-growth mines the combinations of URL tokens that enough pages with a bad label
have (a number of pages, so a small host is not lost among many pages); their
confidence is counted over all labelled pages. Rules are pruned by support,
confidence and lift and by shorter rules that say as much. An inverted index (rarest
token of a rule -> rule) finds the rules a page may meet, and the rule's other
tokens are then verified. A fixed rule list (host suffix, path prefix) goes
before the mined rules; of several entries the longest wins.

Defined cases: a null url or one without ``://`` has empty host and path, no
token and verdict allow; repeated pages are judged each; labels that repeat an
id count as bad if any row does; without labelled pages there are no mined
rules; other columns pass through unless named like the ones added.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import salted_lookup, stored, table

# Fixed values: (rule, verdict); host, then path from the first slash on.
LIST = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.5
#: Bad pages that must meet a rule.
MIN_PAGES = 10
#: Tokens of a rule, label aside.
MAX_TOKENS = 3
#: The index is broadcast up to this many rules (of MAX_TOKENS tokens); beyond,
#: it is joined by salted shuffles.
MAX_RULES = 5_000


def host_of(url: Column) -> Column:
    cut = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(cut, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host: Column, path: Column) -> Column:
    """Host labels and their words, and path words; numbers are one token."""
    def words(text, prefix):
        cut = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")
        return F.transform(cut, lambda t: F.concat(F.lit(prefix), F.when(t.rlike("^[0-9]+$"), "#").otherwise(t)))

    labels = F.transform(F.filter(F.split(host, "[.]"), lambda t: t != ""), lambda t: F.concat(F.lit("d:"), t))
    return F.array_distinct(F.concat(labels, words(host, "h:"), words(path, "p:")))


def listed(host: Column, path: Column, rules=LIST) -> tuple[Column, Column]:
    """(rule, verdict) of the longest entry that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for entry, say in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        h, slash, p = entry.partition("/")
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(slash + p))
        rule, verdict = F.when(fits, entry).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def mine(pages: DataFrame, labels: DataFrame, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE,
         min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules (rule_id, tokens, confidence, pages) from ``labels`` (page_id, bad)."""
    spark = pages.sparkSession
    label = labels.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    known = stored(pages.join(label, "page_id").select("tokens", F.coalesce("bad", F.lit(0)).alias("bad")), "url-baskets")
    n, bad = known.agg(F.count(F.lit(1)), F.sum("bad")).first()
    none = spark.createDataFrame([], "rule_id string, tokens array<string>, confidence double, pages long")
    if not n or not bad or bad < min_pages:
        return none
    # Combinations that ``min_pages`` bad pages have, whatever share of all that is.
    model = FPGrowth(itemsCol="tokens", minSupport=min_pages / bad * (1 - 1e-9)).fit(known.filter("bad = 1"))
    often = (model.freqItemsets.filter(F.size("items") <= MAX_TOKENS)
             .select(F.array_sort("items").alias("tokens"), F.col("freq").alias("pages"))
             .withColumn("rule_id", F.array_join("tokens", " & ")))
    often = stored(often, "url-often")
    # How many labelled pages meet each: a combination is looked up by its rarest
    # token; pages with the same tokens are one row.
    basket = known.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))
    need = index_rules(often.select("rule_id", "tokens"), basket).select("rule_id", "token", F.col("tokens").alias("_need"))
    asked = basket.select("tokens", "n", F.explode("tokens").alias("token"))
    met = asked.join(F.broadcast(need) if often.count() <= MAX_RULES else need, "token")
    met = (met.filter(F.size(F.array_except("_need", "tokens")) == 0).groupBy("rule_id").agg(F.sum("n").alias("_met")))
    base = bad / n
    # A lift cannot pass 1 / base: where most pages are bad, half of what is left to 1 is asked for.
    least = max(min_confidence, min(min_lift * base, (1 + base) / 2))
    confidence = F.col("pages") / F.col("_met")
    rules = stored(often.join(met, "rule_id").withColumn("confidence", confidence).filter(F.col("confidence") >= least)
                   .select("rule_id", "tokens", "confidence", "pages"), "url-rules")

    # A rule goes if a shorter one has a part of its tokens and no less confidence:
    # each rule looks up its own parts, so that no token brings its rules together.
    def part(mask: int) -> Column:
        return F.filter("tokens", lambda t, i: i.isin([k for k in range(MAX_TOKENS) if mask >> k & 1]))

    parts = F.array_distinct(F.array(*[part(m) for m in range(1, (1 << MAX_TOKENS) - 1)]))
    asked = (rules.select("tokens", "confidence", F.explode(parts).alias("part"))
             .filter((F.size("part") > 0) & (F.size("part") < F.size("tokens"))))
    shorter = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("_c"))
    covered = (salted_lookup(asked, shorter, ["part"], F.col("tokens")).filter(F.col("_c") >= F.col("confidence"))
               .select("tokens").distinct())
    return rules.join(covered, "tokens", "left_anti").select(*rules.columns)


def index_rules(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """Inverted index: each rule under the one of its tokens that fewest pages have."""
    rules = stored(rules, "url-kept-rules")
    asked = rules.select("rule_id", "tokens", F.explode("tokens").alias("token"))
    held = pages.select(F.explode("tokens").alias("token"))
    if rules.count() <= MAX_RULES:
        held = held.join(F.broadcast(asked.select("token").distinct()), "token")
    seen = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return (salted_lookup(asked, seen, ["token"], F.col("rule_id"), "left")
            .groupBy("rule_id", "tokens").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))


def judge(pages: DataFrame, labels: DataFrame, rules=LIST) -> DataFrame:
    """``pages`` (page_id, url, ...) with host, path, rule, verdict and mined_rule."""
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("tokens", tokens(F.col("host"), F.col("path")))
    rule, say = listed(F.col("host"), F.col("path"), rules)
    keyed = rows.select("page_id", "tokens")
    index = stored(index_rules(mine(keyed, labels), keyed), "url-index")
    has = F.lit(None).cast("string")
    if not index.isEmpty():
        asked = keyed.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token"))
        need = index.select("rule_id", "token", F.col("tokens").alias("_need"))
        met = (asked.join(F.broadcast(need), "token") if index.count() <= MAX_RULES
               else salted_lookup(asked, need, ["token"], F.col("tokens")))
        met = (met.filter(F.size(F.array_except("_need", "tokens")) == 0)
               .groupBy("tokens").agg(F.min("rule_id").alias("mined_rule")))
        rows = salted_lookup(rows, met, ["tokens"], F.col("page_id"), "left")
        has = F.col("mined_rule")
    else:
        rows = rows.withColumn("mined_rule", has)
    mined = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return rows.withColumn("rule", rule).withColumn("verdict", F.coalesce(say, mined)).drop("tokens")


def page_labels(labels: DataFrame) -> DataFrame:
    """The label table read as labels of the pages with the same ids: bad is poor quality or toxic."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    return labels.filter("doc_id is not null").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


def op4_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return (judge(pages, page_labels(table(spark, sf_dir, "labels")))
            .select("page_id", "host", "path", "rule", "verdict", "mined_rule"))


def _oracle() -> str:
    def words(text: str, prefix: str) -> str:
        cut = f"list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda t: t <> '')"
        return f"list_transform({cut}, lambda t: '{prefix}' || CASE WHEN regexp_matches(t, '^[0-9]+$') THEN '#' ELSE t END)"

    def sets(of: str) -> str:
        """Combinations of one to three of the tokens of each row of ``of``."""
        return (f"SELECT id, [t] AS s FROM {of} UNION ALL "
                f"SELECT a.id, [a.t, b.t] FROM {of} a JOIN {of} b ON a.id = b.id AND a.t < b.t UNION ALL "
                f"SELECT a.id, [a.t, b.t, c.t] FROM {of} a JOIN {of} b ON a.id = b.id AND a.t < b.t JOIN {of} c ON b.id = c.id AND b.t < c.t")

    rule, verdict = [], []
    for entry, say in sorted(LIST, key=lambda r: (-len(r[0]), r[0])):
        h, slash, path = entry.partition("/")
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{slash + path}')"
        rule.append(f"WHEN {fits} THEN '{entry}'")
        verdict.append(f"WHEN {fits} THEN '{say}'")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH u AS (SELECT row_number() OVER () AS id, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{upper}', '{upper.lower()}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
k AS (SELECT *, list_sort(list_distinct(list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda t: t <> ''), lambda t: 'd:' || t),
    list_concat({words('host', 'h:')}, {words('path', 'p:')})))) AS tokens FROM u),
lab AS (SELECT doc_id, max(CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
known AS (SELECT id, tokens, bad FROM k JOIN lab ON lab.doc_id = k.page_id),
total AS (SELECT count(*) AS n, sum(bad) AS bad FROM known),
bt AS (SELECT id, unnest(tokens) AS t FROM known WHERE bad = 1),
common AS (SELECT t FROM bt GROUP BY t HAVING count(*) >= {MIN_PAGES}),
bc AS (SELECT id, t FROM bt SEMI JOIN common USING (t)),
often AS (SELECT s, count(*) AS pages FROM ({sets('bc')}) GROUP BY s HAVING count(*) >= {MIN_PAGES}),
kc AS (SELECT id, t FROM (SELECT id, unnest(tokens) AS t FROM known) SEMI JOIN common USING (t)),
met AS (SELECT s, count(*) AS n FROM ({sets('kc')}) SEMI JOIN often USING (s) GROUP BY s),
r AS (SELECT s, pages / met.n AS c FROM often JOIN met USING (s), total
    WHERE pages / met.n >= greatest({MIN_CONFIDENCE}, least({MIN_LIFT} * total.bad / total.n, (1 + total.bad / total.n) / 2))),
rules AS (SELECT s, array_to_string(s, ' & ') AS rule_id FROM r ANTI JOIN r o
    ON len(o.s) < len(r.s) AND list_has_all(r.s, o.s) AND o.c >= r.c),
hit AS (SELECT k.id, min(rule_id) AS mined_rule FROM k JOIN rules ON list_has_all(k.tokens, rules.s) GROUP BY k.id)
SELECT page_id, host, path, CASE {" ".join(rule)} END AS rule,
  coalesce(CASE {" ".join(verdict)} END, CASE WHEN mined_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, mined_rule
FROM k LEFT JOIN hit USING (id)
"""


ORACLE_SQL = _oracle()
