"""Operator 2: licence recognition by sentence rules (native).

Texts are cut into sentences: at ``. ! ? : ;`` before white space, at lines without
a letter or digit, and behind copyright lines; line ends and comment marks within a
sentence do not matter. Sentences are normalised (lower case, runs of other
characters than a-z and 0-9 become one space; names of holders in two BSD clauses are
left out) and those in the table of known sentences become their identifiers. A
sentence of several lines that is not in the table is looked up again in parts: from
lines on that begin as a known sentence does, then line by line, so notices need no
full stop before them.

The document's sequence of identifiers is matched against ordered rules. Rules are
tried in order, and what a rule matched is taken out before the next, so a whole
licence text is not reported again as its first sentence. DataFrame functions only;
the table is fixed, so no row is shuffled.

Defined cases: a null or empty text has no sentence and no licence; a sentence
that repeats counts each time; each licence is listed once, in rule order; an SPDX
line is read if it names one licence (no ``OR``, ``AND``, ``WITH``); other columns
pass through unless named ``n_sentences``, ``licence_ids`` or ``licences``.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, table

# Sentences of licence texts and notices, normalised, with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0 the license": "apache-notice-long",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-obtain",
    "apache license version 2 0 january 2004 http www apache org licenses": "apache-title",
    "apache license version 2 0 january 2004 https www apache org licenses": "apache-title",
    "the apache software license version 1 1": "apache11-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit-grant-short",
    "the above copyright notice and this permission notice shall be included in all copies": "mit-notice-short",
    "the software is provided as is without warranty of any kind": "as-is-short",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
    "to the following conditions": "mit-grant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
    "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
    "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so":
        "mit0-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software":
        "mit-notice-kept",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial "
    "portions of the software": "mit-notice-kept",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
    "merchantability fitness for a particular purpose and noninfringement": "as-is",
    "redistribution and use in source and binary forms are permitted": "bsd-grant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    "conditions are met": "bsd-grant-full",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer":
        "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
    "the documentation and or other materials provided with the distribution": "bsd-binary",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advert",
    "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission": "bsd-endorse",
    "this software is provided as is and any express or implied warranties including but not limited to the implied warranties of "
    "merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
    "the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that "
    "the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written "
    "agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in "
    "all copies": "postgresql-grant",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and "
    "redistribute it freely subject to the following restrictions": "zlib-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "boost software license version 1 0 august 17th 2003": "boost-title",
    "gnu general public license version 2 june 1991": "gpl2-title",
    "gnu general public license version 3 29 june 2007": "gpl3-title",
    "gnu lesser general public license version 2 1 february 1999": "lgpl21-title",
    "gnu lesser general public license version 3 29 june 2007": "lgpl3-title",
    "gnu affero general public license version 3 19 november 2007": "agpl3-title",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-form",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http www mozilla org mpl 2 0": "mpl-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https www mozilla org mpl 2 0": "mpl-copy",
    "mozilla public license version 2 0": "mpl2-title",
    "the contents of this file are subject to the mozilla public license version 1 1 the license": "mpl11-notice",
    "eclipse public license v 1 0": "epl1-title",
    "eclipse public license v 2 0": "epl2-title",
    "common development and distribution license cddl version 1 0": "cddl-title",
    "licensed under the eupl version 1 2": "eupl-notice",
    "licensed under the eupl version 1 2 or as soon they will be approved by the european commission subsequent versions of the eupl "
    "the licence": "eupl-notice",
    "the artistic license 2 0": "artistic2-title",
    "python software foundation license version 2": "psf2-title",
    "sil open font license version 1 1 26 february 2007": "ofl-title",
    "this font software is licensed under the sil open font license version 1 1": "ofl-notice",
    "cc0 1 0 universal": "cc0-title",
    "do what the fuck you want to public license version 2 december 2004": "wtfpl-title",
    "all rights reserved": "reserved",
}
# Names in short notices ("released under the ..."), normalised: (identifier, licence).
NOTICES = {
    "mit license": ("mit-notice", "MIT"),
    "apache license version 2 0": ("apache-notice", "Apache-2.0"),
    "bsd 2 clause license": ("bsd2-notice", "BSD-2-Clause"),
    "bsd 3 clause license": ("bsd3-notice", "BSD-3-Clause"),
    "isc license": ("isc-notice", "ISC"),
    "zlib license": ("zlib-notice", "Zlib"),
    "boost software license version 1 0": ("boost-notice", "BSL-1.0"),
    "mozilla public license version 2 0": ("mpl2-notice", "MPL-2.0"),
    "eclipse public license version 2 0": ("epl2-notice", "EPL-2.0"),
    "gnu general public license version 2": ("gpl2-notice", "GPL-2.0"),
    "gnu general public license version 3": ("gpl3-notice", "GPL-3.0"),
    "gnu lesser general public license version 2 1": ("lgpl21-notice", "LGPL-2.1"),
    "gnu lesser general public license version 3": ("lgpl3-notice", "LGPL-3.0"),
    "gnu affero general public license version 3": ("agpl3-notice", "AGPL-3.0"),
}
_STARTS = ("licensed under the", "released under the", "distributed under the", "this work is licensed under the",
           "this project is licensed under the", "this software is licensed under the")
#: The GNU family: name in the sentence, identifier, licence, versions.
_GNU = (("general", "gpl", "GPL", ("2", "3")), ("lesser general", "lgpl", "LGPL", ("2 1", "3")), ("affero general", "agpl", "AGPL", ("3",)))
#: Creative Commons 4.0: code and words.
_CC = {"by": "attribution", "by sa": "attribution sharealike", "by nc": "attribution noncommercial", "by nd": "attribution noderivatives",
       "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives"}
# Ordered rules, longer sequences of a licence first.
RULES = (
    ("Apache-2.0", ("apache-title",)),
    ("Apache-2.0", ("apache-notice-long", "apache-comply", "apache-obtain")),
    ("Apache-2.0", ("apache-notice", "apache-comply", "apache-obtain")),
    ("Apache-1.1", ("apache11-title",)),
    ("BSD-4-Clause", ("bsd-grant-full", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-grant-full", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant-full", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-grant", "as-is-short")),
    ("MIT", ("mit-grant", "mit-notice-kept", "as-is")),
    ("MIT", ("mit-grant-short", "mit-notice-short", "as-is-short")),
    ("MIT-0", ("mit0-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("PostgreSQL", ("postgresql-grant",)),
    ("Zlib", ("zlib-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("BSL-1.0", ("boost-title",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("MPL-2.0", ("mpl-form", "mpl-copy")),
    ("MPL-1.1", ("mpl11-notice",)),
    ("EPL-1.0", ("epl1-title",)),
    ("EPL-2.0", ("epl2-title",)),
    ("CDDL-1.0", ("cddl-title",)),
    ("EUPL-1.2", ("eupl-notice",)),
    ("Artistic-2.0", ("artistic2-title",)),
    ("PSF-2.0", ("psf2-title",)),
    ("OFL-1.1", ("ofl-title",)),
    ("OFL-1.1", ("ofl-notice",)),
    ("CC0-1.0", ("cc0-title",)),
    ("WTFPL", ("wtfpl-title",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("AGPL-3.0", ("agpl3-title",)),
)
LAST_RULES = (("All-rights-reserved", ("reserved",)),)


def _plain(text: str) -> str:
    return re.sub("[^a-z0-9]+", " ", text.lower()).strip()


def _derived() -> tuple[dict[str, str], tuple]:
    """Sentences and rules that follow a pattern: notices, GNU terms, Creative Commons, SPDX lines."""
    known, rules = {}, []
    for name, (ident, licence) in NOTICES.items():
        known.update({f"{s} {name}": ident for s in _STARTS})
        rules.append((licence, (ident,)))
    for name, short, licence, versions in _GNU:
        terms = f"you can redistribute it and or modify it under the terms of the gnu {name} public license"
        known[f"{terms} as published by the free software foundation"] = f"{short}-terms"
        for v in versions:
            spdx = f"{licence}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
            slug = v.replace(" ", "")
            later, only = f"either version {v} of the license or at your option any later version", f"version {v} of the license"
            known |= {later: f"v{slug}-later", only: f"v{slug}-only",
                      f"{terms} as published by the free software foundation {later}": f"{short}{slug}-later",
                      f"{terms} as published by the free software foundation {only}": f"{short}{slug}-only",
                      f"{terms} version {v} as published by the free software foundation": f"{short}{slug}-only"}
            rules += [(f"{spdx}-or-later", (f"{short}{slug}-later",)), (f"{spdx}-or-later", (f"{short}-terms", f"v{slug}-later")),
                      (f"{spdx}-only", (f"{short}{slug}-only",)), (f"{spdx}-only", (f"{short}-terms", f"v{slug}-only"))]
    for code, words in _CC.items():
        ident, licence = f"cc-{code.replace(' ', '-')}4", f"CC-{code.upper().replace(' ', '-')}-4.0"
        known |= {f"licensed under cc {code} 4 0": f"{ident}-notice", f"this work is licensed under cc {code} 4 0": f"{ident}-notice",
                  f"this work is licensed under a creative commons {words} 4 0 international license": f"{ident}-notice",
                  f"creative commons {words} 4 0 international public license": f"{ident}-title",
                  f"{words} 4 0 international": f"{ident}-title"}
        rules += [(licence, (f"{ident}-notice",)), (licence, (f"{ident}-title",))]
    for licence in dict.fromkeys(name for name, _ in (*RULES, *rules)):
        ident = f"spdx-{licence.lower()}"
        known[f"spdx license identifier {_plain(licence)}"] = ident
        rules.append((licence, (ident,)))
    return known, tuple(rules)


_MORE, _MORE_RULES = _derived()
KNOWN = SENTENCES | _MORE
ALL_RULES = RULES + _MORE_RULES + LAST_RULES

_CUT = "\x1e"
_SPDX = "spdx-license-identifier:"
#: (pattern, what stands for it, \\1 being its group), in turn: what ends a sentence.
_ENDS = (("(copyright[ \\t]+(?:\\(c\\)|©|[0-9])[^\\n]*)\\n", "\\1" + _CUT), ("\\n[^a-z0-9]*\\n", _CUT),
         ("[.!?:;][\"')]*[ \\t\\r\\f\\n]+", _CUT))
#: Clauses that name the holder, without the name.
_NAMED = (("^neither the name of .* nor the names of its contributors may", "nor the names of its contributors may"),
          ("^this software is provided by .* as is and any express", "this software is provided as is and any express"))


def begin(known: dict[str, str]) -> str:
    """Pattern of a line end before a line that begins with the first three words of a known sentence."""
    heads = sorted({"[^a-z0-9]+".join(s.split()[:3]) for s in known if len(s.split()) > 5})
    return "\\n([^a-z0-9\\n]*(?:" + "|".join(heads or ["\\n"]) + "))"


def sentences(text: Column) -> Column:
    """The sentences of ``text`` in lower case, those without a letter a-z or digit left out."""
    low = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit(_SPDX), F.lit(_SPDX[:-1]))
    for pattern, to in _ENDS:
        low = F.regexp_replace(low, pattern, to.replace("\\1", "$1"))
    return F.filter(F.split(low, _CUT), lambda s: s.rlike("[a-z0-9]"))


def normalised(sentence: Column) -> Column:
    out = F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " "))
    for pattern, to in _NAMED:
        out = F.regexp_replace(out, pattern, to)
    return out


def identifiers(found: Column, known: dict[str, str] = KNOWN) -> Column:
    """Identifiers of the known sentences among ``found``, in their order."""
    ids = F.create_map(*[F.lit(x) for x in chain(*known.items())])
    cut = begin(known)

    def ident(sentence: Column) -> Column:
        return let(normalised(sentence), lambda n: F.when(n.isin(*known), ids[n]))

    def lines(part: Column) -> Column:
        return let(ident(part), lambda i: F.when(i.isNotNull(), F.array(i)).otherwise(F.transform(F.split(part, "\n"), ident)))

    def whole(sentence: Column) -> Column:
        parts = F.split(F.regexp_replace(sentence, cut, _CUT + "$1"), _CUT)
        return let(ident(sentence), lambda i: F.when(i.isNotNull() | ~F.contains(sentence, F.lit("\n")), F.array(i))
                   .otherwise(F.flatten(F.transform(parts, lines))))

    return F.array_compact(F.flatten(F.transform(found, whole)))


def match_rules(ids: Column, rules=ALL_RULES) -> Column:
    """Licences whose sequence of identifiers occurs, without gap, in ``ids``."""
    left = F.concat(F.lit("|"), F.array_join(F.transform(ids, lambda x: F.concat(x, F.lit("|"))), "|"))
    order = F.array(*[F.struct(F.lit("|" + "||".join(seq) + "|").alias("want"), F.lit(name).alias("name")) for name, seq in rules])
    start = F.struct(left.alias("left"), F.array().cast("array<string>").alias("hits"))
    return F.array_distinct(F.aggregate(order, start, lambda acc, r: F.struct(
        F.replace(acc["left"], r["want"], F.lit("|-|")).alias("left"),
        F.when(F.contains(acc["left"], r["want"]), F.array_append(acc["hits"], r["name"])).otherwise(acc["hits"]).alias("hits")))["hits"])


def recognise(docs: DataFrame, known: dict[str, str] = KNOWN, rules=ALL_RULES) -> DataFrame:
    """``docs`` with ``n_sentences``, ``licence_ids`` and ``licences`` (arrays)."""
    found = docs.withColumn("licence_ids", sentences(F.col("text")))
    rows = (found.withColumn("n_sentences", F.size("licence_ids").cast("long"))
            .withColumn("licence_ids", identifiers(F.col("licence_ids"), known)))
    none = F.array().cast("array<string>")
    return rows.withColumn("licences", F.when(F.size("licence_ids") > 0, match_rules(F.col("licence_ids"), rules))
                           .otherwise(none))


def op2_license_scan(spark, sf_dir):
    rows = recognise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_sentences", F.array_join("licence_ids", ",").alias("sentence_ids"),
                       F.array_join("licences", ",").alias("licences"))


def _oracle() -> str:
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def ident(x: str) -> str:
        out = f"trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'))"
        for pattern, to in _NAMED:
            out = f"regexp_replace({out}, {text(pattern)}, {text(to)})"
        return f"m[{out}]"

    low = f"replace(lower(coalesce(text, '')), {text(_SPDX)}, {text(_SPDX[:-1])})"
    for pattern, to in _ENDS:
        put = f"'{to[:-1]}' || chr(30)" if to != _CUT else "chr(30)"
        low = f"regexp_replace({low}, {text(pattern)}, {put}, 'g')"
    known = "MAP {" + ", ".join(f"{text(k)}: {text(v)}" for k, v in KNOWN.items()) + "}"
    rules = ", ".join(f"{{'l': '|{'||'.join(seq)}|', 'h': ['{name}']}}" for name, seq in ALL_RULES)
    return f"""
WITH k AS (SELECT {known} AS m),
p AS (SELECT doc_id, m, list_filter(string_split({low}, chr(30)), lambda x: regexp_matches(x, '[a-z0-9]')) AS p FROM documents, k),
i AS (SELECT doc_id, CAST(len(p) AS BIGINT) AS n_sentences, list_filter(flatten(list_transform(p, lambda x:
    CASE WHEN {ident('x')} IS NOT NULL OR NOT contains(x, chr(10)) THEN [{ident('x')}]
    ELSE flatten(list_transform(string_split(regexp_replace(x, {text(begin(KNOWN))}, chr(30) || '\\1', 'g'), chr(30)), lambda y:
        CASE WHEN {ident('y')} IS NOT NULL THEN [{ident('y')}]
        ELSE list_transform(string_split(y, chr(10)), lambda z: {ident('z')}) END)) END)), lambda x: x IS NOT NULL) AS ids FROM p),
r AS (SELECT doc_id, list_reduce([{rules}], lambda acc, x: {{
    'l': replace(acc.l, x.l, '|-|'),
    'h': CASE WHEN contains(acc.l, x.l) AND NOT list_contains(acc.h, x.h[1]) THEN list_concat(acc.h, x.h) ELSE acc.h END}},
    {{'l': '|' || array_to_string(list_transform(ids, lambda x: x || '|'), '|'), 'h': CAST([] AS VARCHAR[])}}) AS r
  FROM i WHERE len(ids) > 0)
SELECT doc_id, n_sentences, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
  coalesce(array_to_string(r.h, ','), '') AS licences
FROM i LEFT JOIN r USING (doc_id)
"""


ORACLE_SQL = _oracle()
