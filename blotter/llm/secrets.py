"""Operator 9: secret scan over a trigram inverted index (native).

``trigram_query`` derives a Boolean query of mandatory trigrams from each
rule's regex; ``postings`` is the inverted index (trigram, document) of the
trigrams that any rule asks for, stored in the shared folder; ``candidates``
intersects and unites posting lists per rule; ``scan`` verifies the candidates
with the regex itself. A rule without mandatory trigrams scans every text.
Matching uses DataFrame functions only.

Defined cases: a null text is empty; rows that repeat a document id share its
candidate set (a superset for each) and are verified one by one; a null id is
matched null-safely; ``redact`` passes all columns through, whatever their
names (``scan`` replaces one named ``spans``). ``scan`` reports a private key at
its header line; ``redact`` takes out the whole key (``BLOCK``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as S
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lookup, matches, packed, running, small_text_batches, stored, table


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    #: The length of this group must be at least ``least`` for a match to count.
    group: int = 0
    least: int = 1


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_WORDS = [_either(w) for w in ("password", "passwd", "secret", "token")]
# The three base rules, in the order in which kinds are listed.
BASE = (
    Rule("assign", f"({'|'.join(_WORDS)}|{_either('api')}_?{_either('key')})[\"']?\\x20*[:=]\\x20*[\"']?"
                   "([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]+", 0, 16),
)
# Further rules, after the base kinds.
EXTRA = (
    Rule("pem", "-----BEGIN ([A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("slack", "xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]+"),
)
RULES = BASE + EXTRA
# A private key from its header to the END line; where that is missing, over the
# header fields and base64 lines that follow (the last line may be short). Line
# ends may be escaped, and lines quoted, indented or marked. Possessive
# quantifiers: Java repeats such groups without recursion.
_GAP = r"""(?:[\s"',;>|#*-]|\\++[nrt])"""
BLOCK = (EXTRA[0].regex + r"(?:[^-]*+(?:-{1,4}[^-]++)*+-{5,}END (?:[A-Z]+ )?PRIVATE KEY-----"
         + rf"|(?:(?:{_GAP}*+[A-Z][A-Za-z]*+(?:-[A-Za-z]++)*+: [^\r\n\\]*+)*+"
         + rf"(?:{_GAP}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})++(?:{_GAP}++[A-Za-z0-9+/]++={{0,2}}(?=\s*?(?:[\r\n\\\"']|\Z)))?+)?+)")
#: What ``redact`` takes out.
REDACTED = tuple(Rule(r.kind, BLOCK) if r.kind == "pem" else r for r in RULES)
#: Sets of exact strings that grow beyond this are turned into trigrams.
MAX_STRINGS = 64

# A query is True, a trigram, or ("and" | "or", frozenset of queries).


def _join(op: str, parts) -> object:
    flat: set = set()
    for p in parts:
        if p is True:
            if op == "or":
                return True
            continue
        flat |= p[1] if isinstance(p, tuple) and p[0] == op else {p}
    if not flat:
        return True
    # A part that another one implies (or, in an "and", is implied by) says nothing.
    flat = {p for p in flat if not (isinstance(p, tuple) and p[0] != op and p[1] & flat)}
    return next(iter(flat)) if len(flat) == 1 else (op, frozenset(flat))


def _of_strings(strings) -> object:
    return _join("or", [_join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in strings])


def _walk(seq) -> tuple[frozenset | None, object]:
    """(the exact strings that ``seq`` can match, if few; else None, query)."""
    run, ands, exact = frozenset({""}), [], True
    for op, arg in seq:
        strings, query = _node(op, arg)
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        exact = False
        ands += [_of_strings(run), query]
        run = strings if strings is not None else frozenset({""})
    return (run, True) if exact else (None, _join("and", [*ands, _of_strings(run)]))


def _node(op, arg) -> tuple[frozenset | None, object]:
    if op is S.LITERAL:
        return frozenset({chr(arg).lower()}), True
    if op is S.AT:
        return frozenset({""}), True
    if op is S.IN and all(o is S.LITERAL for o, _ in arg):
        return frozenset(chr(a).lower() for _, a in arg), True
    if op is S.SUBPATTERN:
        return _walk(arg[3])
    if op is S.BRANCH:
        parts = [_walk(x) for x in arg[1]]
        if all(s is not None for s, _ in parts):
            return frozenset().union(*(s for s, _ in parts)), True
        return None, _join("or", [_of_strings(s) if s is not None else q for s, q in parts])
    if op in (S.MAX_REPEAT, S.MIN_REPEAT):
        low, high, sub = arg
        strings, query = _walk(sub)
        if strings is not None and (low, high) == (0, 1):
            return strings | {""}, True
        if low == 0:
            return None, True
        return None, _of_strings(strings) if strings is not None else query
    return None, True


def trigram_query(regex: str) -> object:
    """Boolean query of lower-cased trigrams that every match of ``regex`` has."""
    strings, query = _walk(P.parse(regex))
    return _of_strings(strings) if strings is not None else query


def trigrams(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*(trigrams(q) for q in query[1]))


def postings(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Inverted index: one row (trigram, doc_id) for each wanted trigram in a text."""
    low = F.lower(F.coalesce("text", F.lit("")))
    held = [F.when(F.contains(low, F.lit(t)), F.lit(i)) for i, t in enumerate(wanted)]
    return docs.select("doc_id", F.explode(F.array_compact(F.array(*held))).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], wanted: list[str]) -> DataFrame:
    """(doc_id, _c): the rules whose trigram query a document's postings meet."""
    words = range((len(wanted) + 61) // 62)
    bits = [F.bit_or(F.when(F.floor(F.col("trigram") / 62) == w,
                            F.expr("shiftleft(1L, trigram % 62)")).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
            for w in words]
    at = {t: i for i, t in enumerate(wanted)}

    def met(q) -> Column:
        if isinstance(q, str):
            return F.col(f"w{at[q] // 62}").bitwiseAND(F.lit(1 << at[q] % 62).cast("long")) != 0
        parts = [met(x) for x in sorted(q[1], key=str)]
        out = parts[0]
        for p in parts[1:]:
            out = (out & p) if q[0] == "and" else (out | p)
        return out

    kinds = [F.when(met(q), F.lit(r.kind)) for r in rules if (q := trigram_query(r.regex)) is not True]
    return (index.groupBy("doc_id").agg(*bits)
            .select("doc_id", F.array_compact(F.array(*kinds)).alias("_c")).filter(F.size("_c") > 0))


def _found(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, kind number, end) of the leftmost non-overlapping matches."""
    kept = F.filter(matches(text, rule.regex, rule.group), lambda x: F.length(x["part"]) >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["start"], F.lit(order).alias("kind"), x["end"]))


def _fast(rule: Rule) -> Rule:
    """The same matches with the length bound inside the pattern, where the
    pattern is one greedy run to its end (then nothing shorter is consumed)."""
    if rule.group == 0 and (m := re.fullmatch(r"([A-Za-z]*)(\[[^]]+\])\+", rule.regex)):
        return Rule(rule.kind, f"{m[1]}{m[2]}{{{rule.least - len(m[1])},}}", 0, rule.least)
    return rule


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: array of (start, kind, end) in code points, by
    start, then kind (its number in ``rules``)."""
    wanted = sorted(set().union(*(trigrams(trigram_query(r.regex)) for r in rules)))
    index = stored(postings(docs, wanted), "secret-postings")
    rows = lookup(docs, candidates(index, rules, wanted), ["doc_id"], "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    spans = []
    for i, r in enumerate(rules):
        f = _fast(r)
        chosen = text.rlike(f.regex)
        if trigram_query(r.regex) is not True:
            chosen = F.coalesce(F.array_contains("_c", r.kind), F.lit(False)) & chosen
        spans.append(F.when(chosen, _found(text, f, i)).otherwise(none))
    return rows.withColumn("spans", F.array_sort(F.concat(*spans))).drop("_c")


#: Code points of a piece of text that is cut as a whole.
_CHUNK = 4096


def _piece(chunks: Column, start: Column, end: Column) -> Column:
    """The text from ``start`` to ``end``, from its ``chunks``: no cut reads more than one of them."""
    first, last = F.floor(start / _CHUNK).cast("int"), F.floor(end / _CHUNK).cast("int")
    at, to = start % _CHUNK, end % _CHUNK
    head, tail = F.coalesce(F.get(chunks, first), F.lit("")), F.coalesce(F.get(chunks, last), F.lit(""))
    return F.when(first == last, F.substring(head, at + 1, to - at)).otherwise(
        F.concat(F.substring(head, at + 1, F.lit(_CHUNK)), F.array_join(F.slice(chunks, first + 2, last - first - 1), ""),
                 F.substring(tail, F.lit(1), to)))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = REDACTED, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one);
    ``n_chars``, if there, follows. Texts without a span, null ones too, stay."""
    text, ends = F.col("text"), F.transform("spans", lambda s: s["end"])

    def without(chunks: Column, before: Column) -> Column:
        """``before``: the end of what is taken out before each span, and at last."""
        def left(s: Column) -> Column:
            return F.when(s["start"] >= s["at"], F.concat(_piece(chunks, s["at"], s["start"]), F.lit(mark))).otherwise("")

        each = F.zip_with("spans", F.slice(before, F.lit(1), F.size("spans")),
                          lambda s, at: F.struct(s["start"].alias("start"), at.alias("at")))
        rest = _piece(chunks, F.element_at(before, -1), F.length(text))
        return F.concat(F.array_join(F.transform(each, left), ""), rest)

    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0))
    clean = let(cut, lambda chunks: let(running(ends, F.greatest), lambda before: without(chunks, before)))
    hit = F.size("spans") > 0
    new = {"text": F.col("_s"), "n_chars": F.length("_s").cast("long")}
    rows = scan(packed(docs, "doc_id", "text"), rules).withColumn("_s", F.when(hit, clean))
    return rows.select(*[(F.when(hit, new[c]).otherwise(F.col(f"_row.`{c}`")) if c in new else F.col(f"_row.`{c}`")).alias(c)
                         for c in docs.columns])


def _listed(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])),
                        ",")


def op9_secret_scan(spark, sf_dir):
    small_text_batches(spark)
    rows = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    count = [of(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return rows.select("doc_id", *count, F.sha2(_listed(base, RULES), 256).alias("base_sha256"),
                       _listed(F.col("spans"), RULES).alias("spans"))


def _sql_lists(i: int, r: Rule) -> str:
    rx = r.regex.replace("'", "''")
    return (f"list_transform(string_split_regex(text, '{rx}'), lambda x: length(x)) AS gap{i}, "
            f"list_transform(regexp_extract_all(text, '{rx}'), lambda x: length(x)) AS size{i}, "
            f"list_transform(regexp_extract_all(text, '{rx}', {r.group}), lambda x: length(x)) AS held{i}")


def _sql_spans(i: int, r: Rule) -> str:
    return f"""list_transform(list_filter(range(1, len(size{i}) + 1), lambda i: held{i}[i] >= {r.least}), lambda i: {{
      'start': CAST(list_sum(gap{i}[1:i]) + coalesce(list_sum(size{i}[1:i - 1]), 0) AS BIGINT),
      'kind': {i}, 'size': size{i}[i]}})"""


_NAMES = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, {", ".join(_sql_lists(i, r) for i, r in enumerate(RULES))} FROM d),
f AS (SELECT doc_id, list_sort(flatten([{", ".join(_sql_spans(i, r) for i, r in enumerate(RULES))}])) AS s FROM l)
SELECT doc_id,
  {", ".join(f"CAST(len(list_filter(s, lambda x: x.kind = {i})) AS BIGINT) AS n_{r.kind}" for i, r in enumerate(BASE))},
  sha256(array_to_string(list_transform(list_filter(s, lambda x: x.kind < {len(BASE)}),
    lambda x: {_NAMES}[x.kind + 1] || ':' || x.start || ':' || (x.start + x.size)), ',')) AS base_sha256,
  array_to_string(list_transform(s, lambda x: {_NAMES}[x.kind + 1] || ':' || x.start || ':' || (x.start + x.size)), ',') AS spans
FROM f
"""
