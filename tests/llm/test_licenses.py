"""License scans against a plain comparison of every unit and template."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pricefold.llm.licenses import TEMPLATES, THRESHOLD, bigrams, cuts, find_licenses, key_words


def brute(text, templates=TEMPLATES, t=THRESHOLD):
    low = re.sub(r"[^a-z0-9\n\x80-\U0010ffff]", " ", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    units = set(low.split("\n")) | set(re.split(r"\n *\n", low)) | {low}
    units = [[[x for x in u.replace("\n", " ").split(" ") if x]] for u in units]
    every = [x for x in low.replace("\n", " ").split(" ") if x]
    for i, x in enumerate(every):  # the runs at one anchor are one unit
        units.append([every[max(i - before, 0):][:size] for anchor, before, size in cuts(templates) if x == anchor])
    found = []
    for unit in units:
        near = []
        for w in unit:
            a = {f"{x} {y}" for x, y in zip(w, w[1:])}
            for name, body in templates:
                b = set(bigrams(body))
                if a and b and (d := 2.0 * len(a & b) / (len(a) + len(b))) >= t:
                    near.append((-d, -len(b), name))
        found += [m for m in near if m[0] == min(near)[0]]
    return (min(found)[2], -min(found)[0], ",".join(sorted({n for _, _, n in found}))) if found else (None, None, "")


def texts(seed, n=80):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randint(0, 4)):
            name, body = rnd.choice(TEMPLATES)
            w = body.split()
            for _ in range(rnd.choice([0, 0, 1, 2, 8])):
                w[rnd.randrange(len(w))] = rnd.choice(["software", "the", "Über", "license", "x"])
            if rnd.random() < 0.3:
                for k in range(5, len(w), 9):
                    w[k] += "\n"
            body = " ".join(w)
            parts.append(rnd.choice([body, body.upper(), "filler words here", "  " + body + " **", "Größe " + body]))
        out.append(rnd.choice(["\n", "\n\n", "\n \n", " "]).join(parts))
    return out + ["", None, "MIT", "\n\n", "the software license"]


@pytest.mark.parametrize("t", [0.8, 0.5])
def test_matches_equal_brute_force(spark, t):
    rows = [(i if i != 9 else None, x) for i, x in enumerate(texts(int(t * 10)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit(1)).withColumn("low", F.lit("x"))
    got = {r.doc_id: (r.license, r.dice, r.licenses) for r in find_licenses(df, threshold=t).collect()}
    assert got == {i: brute(x, t=t) for i, x in rows}


def test_every_template_finds_itself_and_holds_a_key_word(spark):
    keys = set(key_words([bigrams(b) for _, b in TEMPLATES], THRESHOLD))
    for _, body in TEMPLATES:
        assert keys & {w for b in bigrams(body) for w in b.split()}
    rows = [(i, "first line\n" + b + "\nlast line") for i, (_, b) in enumerate(TEMPLATES)]
    got = find_licenses(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert all(r.dice == 1.0 and TEMPLATES[r.doc_id][0] in r.licenses.split(",") for r in got)


def test_empty_cases_and_native_plan(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.")], "doc_id long, text string")
    assert find_licenses(df.limit(0)).count() == 0
    assert [tuple(r) for r in find_licenses(df, templates=[("x", "one")]).collect()] == [(1, None, None, "")]
    assert not re.search("Python|Pandas|Arrow|Exchange", find_licenses(df)._jdf.queryExecution().executedPlan().toString())


BSD_HEAD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
BSD_1 = ("1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following "
         "disclaimer.")
BSD_2 = ("2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following "
         "disclaimer in the documentation\n   and/or other materials provided with the distribution.")
BSD_3 = ("3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products "
         "derived from\n   this software without specific prior written permission.")
BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
GPL = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version {} of the License, or
(at your option) any later version."""


def test_standard_texts_have_their_own_version(spark):
    owner = "Copyright (c) 2020, Example Inc.\nAll rights reserved."
    cases = [("BSD-2-Clause", "\n\n".join([owner, BSD_HEAD, BSD_1, BSD_2, BSD_END])),
             ("BSD-3-Clause", "\n\n".join([owner, BSD_HEAD, BSD_1, BSD_2, BSD_3, BSD_END])),
             ("GPL-2.0", "a program\n\n" + GPL.format(2) + "\n\nmore text"), ("GPL-3.0", GPL.format(3)),
             ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.")]
    got = find_licenses(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "doc_id int, text string")).collect()
    assert {r.doc_id: r.license for r in got} == {i: name for i, (name, _) in enumerate(cases)}


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: (r.license, r.licenses.split(",")) for r in find_licenses(df).collect()}


def test_notices_within_longer_lines_and_identifiers(spark):
    lgpl = ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
            "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.")
    cases = [("Apache-2.0", "Copyright 2020 Example Inc. All rights reserved. Licensed under the Apache License, Version 2.0. And on it goes."),
             ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"), ("GPL-3.0", "x = 1  # SPDX-License-Identifier: GPL-3.0-or-later"),
             ("LGPL-2.1", "words before " + lgpl + " and words after it, many of them, so that the line is long"),
             ("MIT", "in a line: Released under the MIT License. Then more of the same line"), (None, "a library of free programs under the terms")]
    got = scan(spark, [t for _, t in cases])
    assert {i: x[0] for i, x in got.items()} == {i: n for i, (n, _) in enumerate(cases)}
    assert got[3][1] == ["LGPL-2.1"] and scan(spark, [GPL.format(2)])[0][1] == ["GPL-2.0"]


COMMON = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2",
          "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1",
          "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="no license texts here")
def test_full_texts(spark):
    texts = [open(f"/usr/share/common-licenses/{f}", encoding="utf-8", errors="replace").read() for f in COMMON]
    got = scan(spark, texts)
    assert {f: got[i][0] for i, f in enumerate(COMMON)} == COMMON


def test_a_text_above_a_megabyte(spark):
    text = "some words of no license at all\n" * 40_000
    assert scan(spark, [text + "Released under the MIT License.", text]) == {0: ("MIT", ["MIT"]), 1: (None, [""])}
