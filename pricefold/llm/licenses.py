"""Operator 5: license scans by Dice coefficient over word bigrams (native).

Text is normalised (A-Z lower-cased, every other ASCII character but a-z, 0-9
and line ends a space) and taken in units: each line, each paragraph, the whole
text, and, wherever one of a template's anchors (its longest words) stands, the
run of as many words as the template has, placed so that the anchor falls on its
place in it; all runs at one anchor are one unit, of which the nearest counts.  So a notice within a longer line, or over several lines, is a unit
too.  A unit is compared with a template by their sets of word bigrams::

    dice = 2 |A & B| / (|A| + |B|)

and matches the templates that reach the threshold and no less than any other.

Sizes bound it: a template of n bigrams can only reach ``t`` with units of
``n t / (2 - t)`` to ``n (2 - t) / t`` bigrams, so other templates are pruned
before any intersection.  And such a unit holds at least ``n t / (2 - t)`` of
the template's bigrams, hence one of any ``n - ceil(n t / (2 - t)) + 1`` of them:
texts without one of the key words that hit all those are passed over.

All of it is one projection of DataFrame functions: no shuffle, no Python.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_GNU = ("This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as "
        "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
_GNU_ONLY = ("This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {}General Public License "
             "version {} as published by the Free Software Foundation.")
_PROGRAM, _LIBRARY, _LESSER, _AFFERO = "program", "library", "Lesser ", "Affero "

# Identifiers that may follow "SPDX-License-Identifier:", by name.
SPDX = {
    "MIT": ["MIT"], "Apache-2.0": ["Apache-2.0"], "BSD-2-Clause": ["BSD-2-Clause"], "BSD-3-Clause": ["BSD-3-Clause"], "ISC": ["ISC"],
    "Unlicense": ["Unlicense"], "CC0-1.0": ["CC0-1.0"], "CC-BY-4.0": ["CC-BY-4.0"], "CC-BY-NC-4.0": ["CC-BY-NC-4.0"],
    "CC-BY-SA-4.0": ["CC-BY-SA-4.0"], "MPL-2.0": ["MPL-2.0"], "EPL-2.0": ["EPL-2.0"], "Artistic-2.0": ["Artistic-2.0"],
    "GPL-2.0": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"], "GPL-3.0": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL-2.1": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later"], "LGPL-3.0": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL-3.0": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
}

# Names and texts of license notices and short licenses.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
                   "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
                   "KIND, either express or implied. See the License for the specific language governing permissions and "
                   "limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GNU.format(_PROGRAM, "", 3)),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _GNU.format(_PROGRAM, "", 2)),
    ("GPL-2.0", _GNU_ONLY.format(_PROGRAM, "", 2)),
    ("GPL-3.0", _GNU_ONLY.format(_PROGRAM, "", 3)),
    ("GPL-1.0", _GNU.format(_PROGRAM, "", 1)),
    ("LGPL-2.1", _GNU.format(_LIBRARY, _LESSER, "2.1")),
    ("LGPL-2.1", _GNU_ONLY.format(_LIBRARY, _LESSER, "2.1")),
    ("LGPL-2.0", _GNU.format(_LIBRARY, "Library ", 2)),
    ("LGPL-3.0", _GNU.format(_LIBRARY, _LESSER, 3)),
    ("LGPL-3.0", _GNU_ONLY.format(_LIBRARY, _LESSER, 3)),
    ("AGPL-3.0", _GNU.format(_PROGRAM, _AFFERO, 3)),
    ("AGPL-3.0", _GNU_ONLY.format(_PROGRAM, _AFFERO, 3)),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GFDL-1.2", "GNU Free Documentation License Version 1.2, November 2002"),
    ("GFDL-1.3", "GNU Free Documentation License Version 1.3, 3 November 2008"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use "
                "this file except in compliance with the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide. This software is distributed without any warranty."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Artistic-1.0", "The \"Artistic License\" Preamble The intent of this document is to state the conditions under which a Package may "
                     "be copied"),
    ("Artistic-2.0", "The Artistic License 2.0 Copyright (c) 2000-2006, The Perl Foundation."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-2-Clause", _BSD),
    ("BSD-2-Clause", f"{_BSD} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES} {_BSD_DISCLAIMER}"),
    ("BSD-3-Clause", _BSD_NAMES),
    ("BSD-3-Clause", f"{_BSD} {_BSD_NAMES.replace('copyright holder', 'University')}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
] + [(name, f"SPDX-License-Identifier: {i}") for name, ids in SPDX.items() for i in ids]
THRESHOLD = 0.8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OTHER = "".join(chr(i) for i in range(128) if not (chr(i).isalnum() or chr(i) in "\n\x00"))


ANCHORS = 2  # words of a template at which runs of the text are placed
NO_ANCHORS = {"license", "public", "general"}  # too frequent beside any notice


def words_of(text: str) -> list[str]:
    """Words of a template, normalised."""
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def cuts(templates: list[tuple[str, str]]) -> list[tuple[str, int, int]]:
    """Distinct (anchor, words before it, words in all) of the templates: the
    longest words of each, first occurrences."""
    out = set()
    for _, body in templates:
        words = words_of(body)
        if len(words) > 1:
            for w in sorted(set(words) - NO_ANCHORS, key=lambda w: (-len(w), w))[:ANCHORS]:
                out.add((w, words.index(w), len(words)))
    return sorted(out)


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a template, normalised, in order."""
    words = words_of(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def bounds(n: int, t: float) -> tuple[int, int]:
    """Fewest and most bigrams of a unit that can reach t with n of a template."""
    return math.ceil(n * t / (2 - t) - 1e-9), math.floor(n * (2 - t) / t + 1e-9)


def key_words(sets: list[list[str]], t: float) -> list[str]:
    """Words one of which any matching unit must hold, chosen greedily: the
    fewest words that hit enough bigrams of every template."""
    need = [len(s) - bounds(len(s), t)[0] + 1 for s in sets]
    left = [set(s) for s in sets]
    chosen: list[str] = []
    while any(n > 0 for n in need):
        words = {w for n, s in zip(need, left) if n > 0 for b in s for w in b.split()}
        gain = lambda w: (sum(min(n, sum(w in b.split() for b in s)) for n, s in zip(need, left) if n > 0), len(w), w)  # noqa: B023,E731
        best = max(words, key=gain)
        chosen.append(best)
        for i, s in enumerate(left):
            hit = {b for b in s if best in b.split()}
            need[i] -= len(hit)
            left[i] = s - hit
    return chosen


def _words(unit: Column) -> Column:
    return F.filter(F.split(F.translate(unit, "\n", " "), " "), lambda w: w != "")


def _bigram_set(w: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                                       F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b)))


_SETS = "array<array<array<string>>>"
_MATCHES = "array<struct<dice:double,name:string,n:int>>"


def _at_anchors(w: Column, templates: list[tuple[str, str]]) -> Column:
    """For each anchor in the text the bigram sets of the runs placed at it."""
    of = cuts(templates)
    anchors = F.array(*map(F.lit, sorted({a for a, _, _ in of})))
    held = F.array(*(F.struct(F.lit(a).alias("word"), F.lit(o).alias("before"), F.lit(n).alias("size")) for a, o, n in of))
    at = F.filter(F.transform(w, lambda x, i: F.when(F.array_contains(anchors, x), F.struct(x.alias("word"), i.alias("at")))),
                  lambda x: x.isNotNull())
    runs = F.transform(at, lambda p: F.transform(F.filter(held, lambda c: c["word"] == p["word"]), lambda c: _bigram_set(
        F.slice(w, F.greatest(p["at"] - c["before"], F.lit(0)) + 1, c["size"]))))
    return F.when(F.arrays_overlap(w, anchors), runs).otherwise(F.array().cast(_SETS))


def find_licenses(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, text: str = "text",
                  keep: list[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row, ``license`` and ``dice`` of its best match
    (ties: the template of most bigrams, then the first name) and ``licenses``, the names that its units match, sorted.

    Null, empty and unmatched texts have null license and dice and no names.
    Templates of fewer than two words match nothing.  Repeated rows are rows of
    their own; an empty table gives no rows; columns that are not kept do not
    matter, whatever their names; a long text is scanned whole.
    """
    templates = [(name, body) for name, body in templates if bigrams(body)]
    sets = [(name, bigrams(body)) for name, body in templates]
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _UPPER + _OTHER + "\x00", _LOWER + " " * (len(_OTHER) + 1))
    rows = docs.select(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)), low.alias("low"))
    if not sets:
        found = F.array().cast(_MATCHES)
    else:
        rows = rows.withColumn("words", _words(F.col("low")))
        keys = F.array(*map(F.lit, key_words([b for _, b in sets], threshold)))
        # units: lines, paragraphs, the whole text; a repeated one counts once
        units = F.array_distinct(F.concat(F.split("low", "\n"), F.split("low", r"\n *\n"), F.array("low")))
        units = F.filter(F.transform(units, _words), lambda w: F.arrays_overlap(w, keys))
        units = F.when(F.arrays_overlap("words", keys), F.transform(units, lambda w: F.array(_bigram_set(w)))).otherwise(F.array().cast(_SETS))
        held = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(len(b)).alias("n"), F.lit(bounds(len(b), threshold)[0]).alias("least"),
                                  F.lit(bounds(len(b), threshold)[1]).alias("most"), F.array(*map(F.lit, b)).alias("b"))
                         for name, b in sets))
        rows = rows.withColumn("units", F.concat(units, _at_anchors(F.col("words"), templates)))

        def against(grams: Column) -> Column:
            fit = F.filter(held, lambda t: (F.size(grams) >= t["least"]) & (F.size(grams) <= t["most"]))
            near = F.transform(fit, lambda t: F.struct(
                (F.lit(2.0) * F.size(F.array_intersect(grams, t["b"])) / (F.size(grams) + t["n"])).alias("dice"), t["name"].alias("name"),
                t["n"].alias("n")))
            return F.filter(near, lambda m: m["dice"] >= threshold)

        each = F.transform("units", lambda u: F.flatten(F.transform(u, against)))
        rows = rows.withColumn("matches", F.filter(each, lambda m: F.size(m) > 0))
        # of a unit the templates that come nearest to it
        found = F.flatten(F.transform("matches", lambda m: F.filter(m, lambda x: x["dice"] == F.array_max(F.transform(m, lambda y: y["dice"])))))
    rows = rows.withColumn("found", F.coalesce(found, F.array().cast(_MATCHES)))
    names = F.array_sort(F.array_distinct(F.transform("found", lambda m: m["name"])))
    top = F.array_max(F.transform("found", lambda m: m["dice"]))
    best = F.filter("found", lambda m: m["dice"] == top)
    most = F.array_max(F.transform(best, lambda m: m["n"]))
    first = F.array_min(F.transform(F.filter(best, lambda m: m["n"] == most), lambda m: m["name"]))
    return rows.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)), first.alias("license"), top.alias("dice"),
                       F.array_join(names, ",").alias("licenses"))
