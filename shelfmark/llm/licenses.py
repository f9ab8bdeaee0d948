"""Licence scan by sentence rules.

A text is cut into sentences, sentences are normalised and mapped to identifiers of known licence
sentences, and the sequence of identifiers is matched against ordered rules: the most specific sequence
first, each match taken out of the sequence before the next rule looks at it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import clean_text

#: Words that make a sentence one about a licence, known or not.
HINTS = ("licen", "copyright", "redistribut", "permission", "warrant", "public domain", "spdx")

#: Known sentences: identifier and what the normalised sentence contains, first match wins.
SENTENCES = (
    ("SPDX-Apache-2", r"spdx license identifier apache 2 0"),
    ("SPDX-MIT", r"spdx license identifier mit"),
    ("SPDX-BSD-3", r"spdx license identifier bsd 3 clause"),
    ("SPDX-BSD-2", r"spdx license identifier bsd 2 clause"),
    ("SPDX-GPL-3", r"spdx license identifier gpl 3 0"),
    ("SPDX-GPL-2", r"spdx license identifier gpl 2 0"),
    ("SPDX-MPL-2", r"spdx license identifier mpl 2 0"),
    ("ApacheNotice", r"licensed under the apache license,? version 2 0"),
    ("ApacheComply", r"you may not use this (file|work) except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at"),
    ("ApacheAsIs", r"software distributed under the license is distributed on an as is basis"),
    ("LGPLNotice", r"(gnu )?(lesser|library) general public license"),
    ("AGPLNotice", r"(gnu )?affero general public license"),
    ("GPLFree", r"free software you can redistribute it (and|and or|or) modify it"),
    ("GPLv3OrLater", r"gnu general public license.* version 3.* any later version"),
    ("GPLv2OrLater", r"gnu general public license.* version 2.* any later version"),
    ("GPLv3", r"gnu general public license.* (version |v)3"),
    ("GPLv2", r"gnu general public license.* (version |v)2"),
    ("GPLAny", r"gnu general public license"),
    ("MITNotice", r"(released|licensed|distributed|available) under the( terms of the)? mit license"),
    ("MITGrant", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITInclude", r"the above copyright notice and this permission notice shall be included"),
    ("ISCGrant", r"permission to use copy modify and or distribute this software for any purpose"),
    ("AsIs", r"the software is provided as is"),
    ("BSDRedist", r"redistribution and use in source and binary forms"),
    ("BSDSource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDEndorse", r"neither the name of .* may be used to endorse or promote"),
    ("BSDAsIs", r"this software is provided by the .* as is"),
    ("MPLNotice", r"mozilla public license,? v(ersion)? ?2 0"),
    ("CCBYNCSA", r"\b(cc|creative commons) (by|attribution) (nc|noncommercial) (sa|sharealike)"),
    ("CCBYNCND", r"\b(cc|creative commons) (by|attribution) (nc|noncommercial) (nd|noderivatives)"),
    ("CCBYNC", r"\b(cc|creative commons) (by|attribution) (nc|noncommercial)"),
    ("CCBYSA", r"\b(cc|creative commons) (by|attribution) (sa|sharealike)"),
    ("CCBY", r"\b(cc|creative commons) (by|attribution)"),
    ("CC0", r"\bcc0\b|public domain dedication"),
    ("PublicDomain", r"(released|placed|dedicated) (in|into|to) the public domain"),
    ("Copyright", r"(^| )copyright (c )?[0-9]|all rights reserved"),
)

#: Ordered rules: licence and the run of identifiers that stands for it.
RULES = (
    ("Apache-2.0", ("ApacheNotice", "ApacheComply", "ApacheCopy", "ApacheAsIs")),
    ("Apache-2.0", ("ApacheNotice", "ApacheComply", "ApacheCopy")),
    ("Apache-2.0", ("SPDX-Apache-2",)),
    ("Apache-2.0", ("ApacheNotice",)),
    ("BSD-3-Clause", ("BSDRedist", "BSDSource", "BSDBinary", "BSDEndorse", "BSDAsIs")),
    ("BSD-2-Clause", ("BSDRedist", "BSDSource", "BSDBinary", "BSDAsIs")),
    ("BSD-3-Clause", ("SPDX-BSD-3",)),
    ("BSD-2-Clause", ("SPDX-BSD-2",)),
    ("MIT", ("MITGrant", "MITInclude", "AsIs")),
    ("MIT", ("MITGrant", "MITInclude")),
    ("MIT", ("SPDX-MIT",)),
    ("MIT", ("MITNotice",)),
    ("ISC", ("ISCGrant", "AsIs")),
    ("ISC", ("ISCGrant",)),
    ("GPL-3.0-or-later", ("GPLFree", "GPLv3OrLater")),
    ("GPL-2.0-or-later", ("GPLFree", "GPLv2OrLater")),
    ("GPL-3.0-or-later", ("GPLv3OrLater",)),
    ("GPL-2.0-or-later", ("GPLv2OrLater",)),
    ("GPL-3.0", ("SPDX-GPL-3",)),
    ("GPL-2.0", ("SPDX-GPL-2",)),
    ("GPL-3.0", ("GPLv3",)),
    ("GPL-2.0", ("GPLv2",)),
    ("AGPL", ("AGPLNotice",)),
    ("LGPL", ("LGPLNotice",)),
    ("GPL", ("GPLAny",)),
    ("MPL-2.0", ("SPDX-MPL-2",)),
    ("MPL-2.0", ("MPLNotice",)),
    ("CC-BY-NC-SA", ("CCBYNCSA",)),
    ("CC-BY-NC-ND", ("CCBYNCND",)),
    ("CC-BY-NC", ("CCBYNC",)),
    ("CC-BY-SA", ("CCBYSA",)),
    ("CC-BY", ("CCBY",)),
    ("CC0", ("CC0",)),
    ("Public-Domain", ("PublicDomain",)),
)
UNKNOWN = "Unknown"
#: A sentence ends at .!?;: before white space, at a blank line, or at the end.
SENTENCE_END = r"[.!?;:]+[ \t\r\n]+|\n[ \t\r]*\n|[.!?;:]+$"
#: The same for an engine that goes back: a run of marks is entered at its first one only, and never given up in part.
SENTENCE_END_ONCE = r"(?<![.!?;:])[.!?;:]++(?:[ \t\r\n]++|$)|\n[ \t\r]*+\n"
NOISE = r"[^a-z0-9]+"
#: One of these is in any sentence that has a hint or matches a pattern of the table, and so in any such text,
#: wherever its lines break.
CLUES = ("licen", "copyright", "redistribut", "permission", "warrant", "domain", "spdx", "cc", "creative", "provided", "promote",
         "reserved")
#: Between two words of one sentence, over line breaks and comment marks.
GAP = r"[^a-z0-9.!?]+"
#: Joined before the text is cut: an SPDX key and its value, and the punctuation inside the GNU notices, whose
#: grant then ends as a sentence of its own. Elsewhere ':' and ';' end one, as before the items of a list.
JOINS = (
    (rf"\bspdx{GAP}license{GAP}identifier[ \t]*:[ \t\r\n]*", "spdx license identifier "),
    (GAP.join(r"\bfree software you can redistribute it (?:and|or|and/or) modify it\b".split()),
     "free software you can redistribute it and or modify it. "),
    (GAP.join(r"\bfree software foundation either version\b".split()), "free software foundation either version"),
)


def rule_text(ids: Sequence[str]) -> str:
    return "".join(f"<{i}>" for i in ids)


def _any(text: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def _matches(sentence: Column, pattern: str) -> Column:
    """Whether a sentence holds a pattern, in time that grows with the sentence only.

    What stands between gaps (`.*`) is looked for one after the other, each from behind the first place of the
    one before, instead of trying every pair of places. All but the last are plain words.
    """
    *parts, last = pattern.split(".*")
    held, rest = F.lit(True), sentence
    for part in parts:
        held = held & F.contains(rest, F.lit(part))
        rest = F.substr(rest, F.instr(rest, part) + len(part))
    return held & F.regexp_like(rest, F.lit(last))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, sentence_ids, licenses, n_known, n_unknown, status.

    `sentence_ids` is the sequence of identifiers in the order of the text, `<Unknown>` for a sentence
    that names a licence but is not in the table; `licenses` lists the matched licences in the order of
    the rules, each once. `status` is none, known, partial (licences and unknown sentences) or unknown.

    Whole texts are read, whatever their length. A null or empty text has no sentence, a null doc_id is
    reported like any other, repeated rows are reported each, and other columns are ignored.
    """
    lower = F.lower(clean_text())
    joined = reduce(lambda text, j: F.regexp_replace(text, j[0], j[1]), JOINS, F.when(_any(lower, CLUES), lower).otherwise(F.lit("")))
    sentences = F.transform(F.split(joined, SENTENCE_END_ONCE), lambda s: F.trim(F.regexp_replace(s, NOISE, " ")))
    near = F.filter(sentences, lambda s: _any(s, CLUES))

    def identify(sentence: Column) -> Column:
        out = F
        for name, pattern in SENTENCES:
            out = out.when(_matches(sentence, pattern), F.lit(name))
        return out.when(_any(sentence, HINTS), F.lit(UNKNOWN))

    ids = F.array_compact(F.transform(near, identify))
    rows = docs.select("doc_id", F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("sentence_ids"))
    # One rule after the other: what it matches is set apart by a bar, so that no run closes over a gap.
    rows = rows.withColumn("_left", F.col("sentence_ids"))
    found = []
    for k, (licence, run) in enumerate(RULES):
        hit = F.contains("_left", F.lit(rule_text(run)))
        rows = rows.withColumn(f"_hit{k}", F.when(hit, F.lit(licence)))
        rows = rows.withColumn("_left", F.replace("_left", F.lit(rule_text(run)), F.lit("|")))
        found.append(F.col(f"_hit{k}"))
    names = F.array_distinct(F.array_compact(F.array(*found)))
    total = F.regexp_count("sentence_ids", F.lit("<"))
    unknown = F.regexp_count("sentence_ids", F.lit(f"<{UNKNOWN}>"))
    status = (F.when(total == 0, "none").when(F.size(names) == 0, "unknown")
              .when(unknown > 0, "partial").otherwise("known"))
    return rows.select(
        "doc_id", "sentence_ids", F.array_join(names, ",").alias("licenses"),
        (total - unknown).cast("long").alias("n_known"), unknown.cast("long").alias("n_unknown"),
        status.alias("status"))


def scan_sql() -> str:
    """The same scan as DuckDB SQL over `documents`."""
    def any_of(column: str, hints: Sequence[str]) -> str:
        return "(" + " OR ".join(f"contains({column}, '{h}')" for h in hints) + ")"

    cases = " ".join(f"WHEN regexp_matches(s, '{p}') THEN '<{n}>'" for n, p in SENTENCES)
    steps, names = [], []
    for k, (licence, run) in enumerate(RULES):
        before = f"left{k}"
        steps.append(f"r{k} AS (SELECT *, CASE WHEN contains({before}, '{rule_text(run)}') THEN '{licence}' END AS hit{k}, "
                     f"replace({before}, '{rule_text(run)}', '|') AS left{k + 1} FROM {'ids' if k == 0 else f'r{k - 1}'})")
        names.append(f"hit{k}")
    joined = "t"
    for pattern, text in JOINS:
        joined = f"regexp_replace({joined}, '{pattern}', '{text}', 'g')"
    return f"""
WITH low AS (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents),
joined AS (SELECT doc_id, {joined} AS t FROM low),
cut AS (SELECT doc_id, list_transform(string_split_regex(t, '{SENTENCE_END}'), lambda s: trim(regexp_replace(s, '{NOISE}', ' ', 'g'))) AS parts FROM joined),
ids AS (SELECT doc_id, array_to_string(list_filter(list_transform(parts, lambda s: CASE {cases} WHEN {any_of('s', HINTS)} THEN '<{UNKNOWN}>' END),
    lambda x: x IS NOT NULL), '') AS sentence_ids, sentence_ids AS left0 FROM cut),
{', '.join(steps)},
out AS (SELECT doc_id, sentence_ids, list_filter([{', '.join(names)}], lambda x: x IS NOT NULL) AS hits,
    (length(sentence_ids) - length(replace(sentence_ids, '<', ''))) AS total,
    ((length(sentence_ids) - length(replace(sentence_ids, '<{UNKNOWN}>', ''))) // {len(UNKNOWN) + 2}) AS n_unknown
    FROM r{len(RULES) - 1})
SELECT doc_id, sentence_ids,
    array_to_string(list_filter(hits, lambda x, i: list_position(hits, x) = i), ',') AS licenses,
    CAST(total - n_unknown AS BIGINT) AS n_known, CAST(n_unknown AS BIGINT) AS n_unknown,
    CASE WHEN total = 0 THEN 'none' WHEN len(hits) = 0 THEN 'unknown' WHEN n_unknown > 0 THEN 'partial' ELSE 'known' END AS status
FROM out"""
