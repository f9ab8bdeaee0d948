"""Licence scan on hand-computed texts."""

import re
import time
from re import _constants as code
from re import _parser as parser

import duckdb
import pytest

from shelfmark.llm import licenses


def scan(spark, texts):
    rows = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r["doc_id"])]


SPDX = {
    "Apache-2.0": ("SPDX-Apache-2", "Apache-2.0"), "MIT": ("SPDX-MIT", "MIT"), "BSD-3-Clause": ("SPDX-BSD-3", "BSD-3-Clause"),
    "BSD-2-Clause": ("SPDX-BSD-2", "BSD-2-Clause"), "GPL-3.0": ("SPDX-GPL-3", "GPL-3.0"), "GPL-2.0": ("SPDX-GPL-2", "GPL-2.0"),
    "MPL-2.0": ("SPDX-MPL-2", "MPL-2.0"),
}


@pytest.mark.parametrize("before, after", [("", ""), ("# ", "\nimport os\n"), ("Some code. /* ", " */\nint x;")])
def test_spdx_headers(spark, before, after):
    got = scan(spark, [f"{before}SPDX-License-Identifier: {key}{after}" for key in SPDX])
    assert got == [(f"<{name}>", licence, 1, 0, "known") for name, licence in SPDX.values()]


GRANT = "This program is free software{0} you can redistribute it and/or modify\n{3}it under the terms of the GNU {1}General Public License as published by\n{3}the Free Software Foundation{2} of the License, or\n{3}(at your option) any later version."


def test_gnu_notices(spark):
    got = scan(spark, [
        GRANT.format(":", "", ", either version 3", ""), GRANT.format(";", "", "; either version 2", " * "),
        GRANT.format(":", "", ", either version 3", "# "), GRANT.format(";", "Lesser ", "; either version 2.1", ""),
        GRANT.format(":", "Affero ", ", either version 3", "")])
    assert got == [
        ("<GPLFree><GPLv3OrLater>", "GPL-3.0-or-later", 2, 0, "known"), ("<GPLFree><GPLv2OrLater>", "GPL-2.0-or-later", 2, 0, "known"),
        ("<GPLFree><GPLv3OrLater>", "GPL-3.0-or-later", 2, 0, "known"), ("<GPLFree><LGPLNotice>", "LGPL", 2, 0, "known"),
        ("<GPLFree><AGPLNotice>", "AGPL", 2, 0, "known")]


def test_a_colon_still_ends_the_sentence_before_a_list(spark):
    text = ("Redistribution and use in source and binary forms are permitted provided that these conditions are met:\n"
            "* Redistributions of source code must retain the above copyright notice;\n"
            "* Redistributions in binary form must reproduce the above copyright notice.\n"
            'THIS SOFTWARE IS PROVIDED BY THE AUTHORS "AS IS" WITHOUT WARRANTY.')
    assert scan(spark, [text]) == [("<BSDRedist><BSDSource><BSDBinary><BSDAsIs>", "BSD-2-Clause", 4, 0, "known")]


#: Texts of one sentence, some broken into two lines.
ALONE = {
    "CC BY-SA 4.0": ("CCBYSA", "CC-BY-SA"), "Creative Commons Attribution 4.0": ("CCBY", "CC-BY"), "CC Attribution": ("CCBY", "CC-BY"),
    "Creative\nCommons Attribution-NonCommercial 4.0": ("CCBYNC", "CC-BY-NC"), "CC-BY-NC-ND": ("CCBYNCND", "CC-BY-NC-ND"),
    "Texts: CC0": ("CC0", "CC0"), "CC0-1.0": ("CC0", "CC0"), "Public Domain\nDedication": ("CC0", "CC0"),
    "This work is released into the public\n domain.": ("PublicDomain", "Public-Domain"),
    'The software is provided "as is".': ("AsIs", ""), 'This software is provided by the authors "as is".': ("BSDAsIs", ""),
    "Neither the name of X nor Y may be used to endorse or promote Z.": ("BSDEndorse", ""), "All rights reserved.": ("Copyright", ""),
    "Some words. All Rights\nReserved": ("Copyright", ""),
}


def test_a_sentence_of_the_table_alone(spark):
    got = scan(spark, ALONE)
    assert got == [(f"<{name}>", licence, 1, 0, "known" if licence else "unknown") for name, licence in ALONE.values()]


def test_parts_of_words_are_no_licence(spark):
    assert scan(spark, ['token = "bee4a2827eb113d73cb298acc0f7"', "Provided by mail, of course", "In the domain of creative work"]) == [("", "", 0, 0, "none")] * 3


def by_sql(texts):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    return [tuple(r)[1:] for r in con.execute(licenses.scan_sql() + " ORDER BY doc_id").fetchall()]


def test_sql_says_the_same(spark):
    texts = [f"# SPDX-License-Identifier: {key}\nimport os\n" for key in SPDX] + list(ALONE)
    texts += [GRANT.format(*x) for x in ((":", "", ", either version 3", ""), (";", "Lesser ", "; either version 2.1", " * "))]
    texts += ["", "...", "a licence we do not know.. And more; copyright 2020 X", "in the domain. of creative work: success according to cc", "license" + "." * 50,
              "x\n \t\ny license\n\n\nz. copyright (c) 1999", "GNU General Public License version 2 and any later version, or v3"]
    assert scan(spark, texts) == by_sql(texts)


def test_time_grows_with_the_text(spark):
    texts = ["license " + "." * 1_000_000, "license " + ".;:!?" * 200_000 + "x", "gnu general public license version 3 " * 5_000,
             "this software is provided by the " * 5_000 + "license", "neither the name of " * 5_000, "license" + "\n \t\r" * 100_000,
             "free software " * 20_000 + "license", "spdx - license - " * 20_000]
    begun = time.perf_counter()
    got = scan(spark, texts)
    assert time.perf_counter() - begun < 40
    assert got[0] == ("<Unknown>", "", 0, 1, "unknown") and got[2][0] == "<GPLv3>"


def samples(node):
    """Texts that a parsed pattern matches: every alternative, optional parts with and without."""
    out = [""]
    for kind, value in node:
        if kind == code.LITERAL:
            more = [chr(value)]
        elif kind == code.BRANCH:
            more = [t for branch in value[1] for t in samples(branch)]
        elif kind == code.SUBPATTERN:
            more = samples(value[-1])
        elif kind == code.MAX_REPEAT:
            more = ([""] if value[0] == 0 else []) + ([" x "] if value[2][0][0] == code.ANY else samples(value[2]))
        elif kind == code.IN:
            more = ["0"]
        else:
            more = [""]  # a boundary
        out = [a + b for a in out for b in more]
    return out


def test_every_pattern_has_a_clue():
    for name, pattern in licenses.SENTENCES:
        for text in samples(parser.parse(pattern)):
            assert re.search(pattern, text), (name, text)
            assert any(c in text for c in licenses.CLUES), (name, text)
