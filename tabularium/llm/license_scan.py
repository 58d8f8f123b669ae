"""Licence scan: Dice coefficient over word bigrams against licence templates, in DataFrame functions only.

A text is normalised (lower case; everything but a-z and 0-9 is a blank). Its
units are its lines, its paragraphs, the whole text, and windows of consecutive
words: for each template those of the template's length that start with one
of its bigrams, so a licence is found wherever it stands, over several
paragraphs or within a line. A unit is compared, as a set of word bigrams, with
each template that its size allows: a coefficient of ``t`` needs sizes within a
factor of ``t / (2 - t)``. Windows are cut for a template only if the whole text
has as many of its bigrams as the smallest such set. A text's result is the match
with the most bigrams in common, so that a short notice within a licence doesn't hide it.

Most texts of a corpus hold no licence at all. A match shares at least
``t / (2 - t)`` of the template's bigrams, so if all but fewer of a template's
bigrams contain one of a few anchor words, every match contains such a word.
``anchors`` picks the words by that rule; a text without any is done after one
search for them. Nothing is shuffled, and templates are literals in the plan.

Results defined for odd input: null and empty texts, and texts without a
match, have a null licence, coefficient 0 and no match; units of one word have
no bigram and never match; of several matches the one with most bigrams in
common is reported, then the higher coefficient, then the first licence by name; repeated rows give repeated result rows; columns with any names are
carried if they are listed in ``keep``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import free_names

THRESHOLD = 0.8

#: Parts of the BSD licences.
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution. "
)
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
#: Public licence texts and notices.
TEMPLATES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD '
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", BSD_GRANT + BSD_CLAUSES + BSD_DISCLAIMER),
    (
        "BSD-3-Clause",
        BSD_GRANT + BSD_CLAUSES + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission. " + BSD_DISCLAIMER,
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
        "use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this "
        'license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to '
        "permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in "
        "part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by "
        'a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE "
        "BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this "
        "software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that "
        "recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this "
        "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF "
        "ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND "
        "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the "
        "Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("LicenseRef-All-rights-reserved", "All rights reserved."),
]


def normal_words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams(text: str) -> list[str]:
    """Different word bigrams, in order."""
    words = normal_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:], strict=False)))


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes of sets that can have a coefficient of ``threshold`` with a set of ``n``."""
    least = threshold / (2 - threshold)
    return math.ceil(n * least - 1e-9), math.floor(n / least + 1e-9)


def anchors(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words, and bigrams of short words, of which every unit that matches a template has one."""
    open_ = []
    for _, text in templates:
        grams = bigrams(text)
        # A match shares so many bigrams; without an anchor it could only share the others.
        open_.append((grams, size_bounds(len(grams), threshold)[0]))
    chosen: list[str] = []
    bare = lambda g: g not in chosen and not set(g.split()) & set(chosen)
    while True:
        short = [(g, need) for g, need in open_ if sum(map(bare, g)) >= need]
        if not short:
            return sorted(chosen)
        gain: dict[str, float] = {}
        for grams, _ in short:
            for g in filter(bare, grams):
                # Short words are everywhere: the longer word of a bigram is a candidate, or both together.
                w = max(sorted(g.split()), key=len)
                w = w if len(w) > 4 else g
                gain[w] = gain.get(w, 0) + len(w) ** 2 / len(grams)
        chosen.append(max(sorted(gain), key=gain.get))


def _words(unit: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(unit), "[^a-z0-9]+", " ")), " ")


def _pairs(words: Column) -> Column:
    """All word bigrams, in order."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))


def _let(value: Column, f) -> Column:
    """``f(value)``, with ``value`` computed once: inside a lambda an expression would be computed for each element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def best_match(text: Column, templates: list[tuple[str, str]], threshold: float) -> Column:
    """A struct of the best match's coefficient, licence and number of matching licences, null without any."""
    sized = [(name, bigrams(t), len(normal_words(t)) - 1) for name, t in templates]
    low = min(size_bounds(len(g), threshold)[0] for _, g, _ in sized)
    high = max(size_bounds(len(g), threshold)[1] for _, g, _ in sized)
    table = F.array(
        *(
            F.struct(
                F.lit(name).alias("name"),
                F.lit(len(g)).alias("n"),
                F.lit(width).alias("width"),
                F.lit(size_bounds(len(g), threshold)[0]).alias("low"),
                F.lit(size_bounds(len(g), threshold)[1]).alias("high"),
                F.array(*map(F.lit, g)).alias("grams"),
            )
            for name, g, width in sized
        )
    )

    def match(g: Column, t: Column) -> Column:
        common = F.size(F.array_intersect(g, t["grams"]))
        return F.struct((-common).alias("common"), (F.lit(-2.0) * common / (F.size(g) + t["n"])).alias("dice"), t["name"].alias("name"))

    def compare(g: Column) -> Column:
        return F.transform(F.filter(table, lambda t: F.size(g).between(t["low"], t["high"])), lambda t: match(g, t))

    def windows(pairs: Column, t: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(pairs), F.lit(1))), lambda p: F.array_contains(t["grams"], F.get(pairs, p - 1)))
        return F.transform(starts, lambda p: _let(F.array_distinct(F.slice(pairs, p, t["width"])), lambda g: match(g, t)))

    def within(pairs: Column) -> Column:
        may = F.filter(table, lambda t: F.size(F.array_intersect(pairs, t["grams"])) >= t["low"])
        return F.flatten(F.transform(may, lambda t: windows(pairs, t)))

    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, "\n[ \t\r]*\n"), F.array(text)))
    words = F.transform(units, _words)
    # A set of bigrams is no larger than the number of words, so units too short or too long for all templates go first.
    grams = F.transform(F.filter(words, lambda w: F.size(w) > low), lambda w: F.array_distinct(_pairs(w)))
    grams = F.filter(grams, lambda g: F.size(g).between(low, high))
    every = F.concat(F.flatten(F.transform(grams, compare)), _let(_let(_words(text), _pairs), within))
    found = F.filter(every, lambda m: m["dice"] <= -threshold)
    best = lambda ms: F.struct((-F.array_min(ms)["dice"]).alias("dice"), F.array_min(ms)["name"].alias("license"), F.size(F.array_distinct(F.transform(ms, lambda m: m["name"]))).alias("matches"))
    return _let(found, lambda ms: F.when(F.size(ms) > 0, best(ms)))


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` (all other columns by default), ``license``, ``dice`` and ``n_matches`` for every row.

    ``n_matches`` counts the different licences that some unit matches.
    """
    kept = keep if keep is not None else [c for c in docs.columns if c != text_col]
    lowered = F.lower(F.col(text_col))
    may = F.lit(False)
    for word in anchors(templates, threshold):
        may = may | (F.rlike(lowered, F.lit(word.replace(" ", "[^a-z0-9]+"))) if " " in word else F.contains(lowered, F.lit(word)))
    found = F.when(may, best_match(F.col(text_col), templates, threshold))
    (name,) = free_names(kept, "found")
    rows = docs.select(*(F.col(c) for c in kept), found.alias(name))
    return rows.select(
        *kept,
        F.col(f"{name}.license").alias("license"),
        F.coalesce(f"{name}.dice", F.lit(0.0)).alias("dice"),
        F.coalesce(F.col(f"{name}.matches"), F.lit(0)).cast("long").alias("n_matches"),
    )


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same result in DuckDB: every unit against every template, without size bounds or anchor words."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quoted(name)}, {len(normal_words(t)) - 1}, [{', '.join(map(quoted, bigrams(t)))}])" for k, (name, t) in enumerate(templates))
    plain = lambda s: f"string_split(trim(regexp_replace(lower({s}), '[^a-z0-9]+', ' ', 'g')), ' ')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH template(t, name, width, grams) AS (VALUES {rows}),
doc AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
unit AS (
  SELECT DISTINCT r, u FROM (
    SELECT r, unnest(list_concat(string_split(text, chr(10)), string_split_regex(text, '\\n[ \\t\\r]*\\n'), [text])) AS u FROM doc WHERE text IS NOT NULL)),
gram AS (SELECT r, list_distinct({pairs}) AS g FROM (SELECT r, {plain('u')} AS w FROM unit) WHERE len(w) > 1),
pair AS (SELECT r, {pairs} AS p FROM (SELECT r, {plain('text')} AS w FROM doc WHERE text IS NOT NULL) WHERE len(w) > 1),
place AS (SELECT r, unnest(p) AS gram, unnest(range(1, len(p) + 1)) AS i FROM pair),
start AS (SELECT DISTINCT r, t, i FROM place JOIN (SELECT t, unnest(grams) AS gram FROM template) USING (gram)),
wide AS (SELECT r, name, grams, list_distinct(p[i : i + width - 1]) AS g FROM start JOIN template USING (t) JOIN pair USING (r)),
pot AS (SELECT r, name, grams, g FROM gram, template UNION ALL FROM wide),
scored AS (SELECT r, name, len(list_intersect(g, grams)) AS common, len(g) + len(grams) AS sizes FROM pot),
hit AS (SELECT r, name, common, 2.0::DOUBLE * common / sizes AS dice FROM scored WHERE 2.0::DOUBLE * common / sizes >= {threshold}),
best AS (SELECT r, name AS license, dice FROM hit QUALIFY row_number() OVER (PARTITION BY r ORDER BY common DESC, dice DESC, name) = 1),
kinds AS (SELECT r, count(DISTINCT name) AS n FROM hit GROUP BY r)
SELECT doc_id, license, coalesce(dice, 0.0) AS dice, coalesce(n, 0)::BIGINT AS n_matches
FROM doc LEFT JOIN best USING (r) LEFT JOIN kinds USING (r)
"""
