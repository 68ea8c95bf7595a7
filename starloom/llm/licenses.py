"""Licence scan: headers and licence files against templates, then inheritance by directory.

Every line of a file is a unit, and so are a licence file as a whole and, of other files, the leading
comment lines, all of them and each paragraph. Templates are notices of a line, headers of several
lines and whole licence texts. A unit's vector holds the inverse
document frequency of its words (a word counts once), a template's likewise; a unit is under the
licence of the template with the largest cosine, from a threshold on. Words that no template has
add to a unit's length only, all with the same weight, so units that say other things than a
template fall behind. A file without a licence of its own has that of the nearest directory above
it whose licence file has one.

DataFrame operations only.
"""

from __future__ import annotations

import json
import math
import pkgutil
import re
import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.operators.join import lookup

THRESHOLD = 0.75

# Usual licence notices, by SPDX identifier.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
]
#: So many templates are of one line.
LINES = len(TEMPLATES)

_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. """
_NO_ENDORSEMENT = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. """
_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {licence} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
_GNU_MORE = """
This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {licence} for more details. You should have
received a copy of the GNU {licence} along with this {what}. If not, see https://www.gnu.org/licenses/."""
_REMOTE = """
GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007. Remote Network Interaction; Use with the GNU General
Public License. Notwithstanding any other provision of this License, if you modify the Program, your modified version
must prominently offer all users interacting with it remotely through a computer network (if your version supports such
interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding
Source from a network server at no charge, through some standard or customary means of facilitating copying of software."""


def _text(name: str) -> str:
    """A text without what looks like tags, which pages do not have either."""
    return re.sub("[<>]", " ", (pkgutil.get_data(__package__, f"licence_texts/{name}.txt") or b"").decode())


def _gnu(name: str, licence: str, version: str, what: str) -> list[tuple[str, str]]:
    """The usual header's first paragraph and all of it."""
    head, more = (t.format(licence=licence, version=version, what=what) for t in (_GNU, _GNU_MORE))
    return [(name, head), (name, head + more)]


# Headers of several lines and whole texts.
TEMPLATES += [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    *_gnu("AGPL-3.0", "Affero General Public License", "3", "program"),
    *_gnu("GPL-2.0", "General Public License", "2", "program"),
    *_gnu("GPL-3.0", "General Public License", "3", "program"),
    *_gnu("LGPL-2.1", "Lesser General Public License", "2.1", "library"),
    *_gnu("LGPL-3.0", "Lesser General Public License", "3", "library"),
    ("BSD-2-Clause", _REDISTRIBUTION + _DISCLAIMER),
    ("BSD-3-Clause", _REDISTRIBUTION + _NO_ENDORSEMENT + _DISCLAIMER),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL
DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of
this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for
the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an
overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to
https://unlicense.org"""),
    ("AGPL-3.0", _text("GPL-3.0") + _REMOTE),
    *((name, _text(name)) for name in ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")),
]
#: Lines that are part of other licences' texts too.
RESERVED = "Proprietary"
#: Marks that begin a comment line.
COMMENT = "^[ \\t]*(#|//|/\\*|\\*|--[ \\t]|;|%|<!--|\"\"\"|''')"
#: Names of licence files, without an extension.
LICENCE_FILE = "(?i)^(un)?licen[cs]e|^copying|^notice"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Distinct words: runs of a-z and digits, A-Z being lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit("[a-z0-9]+"), F.lit(0)))


def html_lines(html: Column) -> Column:
    """Tags end lines: what stands between a ``<`` and the next ``>`` becomes a line break.

    Text is cut at each ``>``, in time linear in its length, however many ``<`` are never closed.
    """
    rest = F.substring_index(html, ">", -1)
    closed = F.substr(html, F.lit(1), F.length(html) - F.length(rest))

    def shown(part: Column) -> Column:
        tag = F.concat(F.substring_index(part, "<", 1), F.lit("\n"))
        return F.when(F.contains(part, F.lit("<")), tag).otherwise(F.concat(part, F.lit(">")))

    # What follows the last > is an empty part, which has been given a > of its own.
    text = F.array_join(F.transform(F.split(closed, ">"), shown), "")
    return F.concat(F.regexp_replace(text, ">\\z", ""), rest)


def url_path(url: Column) -> Column:
    """Host and path of a URL, ``host/dir/name``."""
    return F.regexp_extract(url, "://([^?#]*)", 1)


def _template_words() -> list[tuple[str, int, list[str]]]:
    return [(name, n, sorted(set(re.findall("[a-z0-9]+", text.lower())))) for n, (name, text) in enumerate(TEMPLATES)]


def _header(text: Column) -> Column:
    """Leading comment lines, together and by paragraph: a block comment, or lines that have a mark."""
    block = F.regexp_extract(text, "(?s)^\\s*(/\\*.*?\\*/|<!--.*?-->|\"\"\".*?\"\"\"|'''.*?''')", 1)
    lines = F.split(F.regexp_replace(text, "^\\s*\\n", ""), "\\n")
    marked = F.transform(lines, lambda line: line.rlike(COMMENT) | line.rlike("^[ \\t\\r]*$"))
    count = F.coalesce(F.nullif(F.array_position(marked, False), F.lit(0)) - 1, F.size(lines)).cast("int")
    leading = F.rtrim(F.array_join(F.slice(lines, F.lit(1), count), "\n"), F.lit(" \t\n\x0b\f\r"))
    header = F.when(block != "", block).otherwise(leading)
    paragraphs = F.split(header, "\\n[^A-Za-z0-9\\n]*(?=\\n)")
    return F.when(F.regexp_replace(text, "^\\s*\\n", "").rlike(COMMENT), F.concat(F.array(header), paragraphs))


def _texts(files: DataFrame) -> Column:
    """The units of a file."""
    none = F.array().cast("array<string>")
    whole = F.when(F.col("is_licence"), F.array("text")).otherwise(F.coalesce(_header(F.col("text")), none))
    return F.array_distinct(F.concat(F.split("text", "\\n"), whole))


def _units(files: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Units that have some word of a template: which of these, and how many words."""
    words = F.transform(_texts(files), words_of)
    known = F.transform(words, lambda ws: F.struct(F.filter(ws, lambda w: w.isin(vocabulary)).alias("known"), F.size(ws).alias("size")))
    # In the generator, each is computed once.
    units = files.select("path", "is_licence", F.explode(F.filter(known, lambda u: F.size(u["known"]) > 0)).alias("unit"))
    return units.select("path", "is_licence", "unit.known", (F.col("unit.size") - F.size("unit.known")).alias("others"))


def _weights(units: DataFrame, vocabulary: list[str], count: int) -> dict[str, float]:
    """Inverse document frequency of each template word over all units."""
    found = units.select(F.explode("known").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    seen = {r.word: r.n for r in found.collect()}  # a row per template word at most
    return {word: math.log((1 + count) / (1 + seen.get(word, 0))) + 1 for word in vocabulary}


def _squares(weights: dict[str, float]) -> Callable[[Column], Column]:
    """Squared weights by word, in small maps by hash, as a map is searched from end to end."""
    size = 1 << len(weights).bit_length()
    maps: list[dict[str, float]] = [{} for _ in range(size)]
    for word, weight in weights.items():
        maps[zlib.crc32(word.encode()) % size][word] = weight**2
    table = F.from_json(F.lit(json.dumps(maps)), "array<map<string,double>>")
    return lambda w: F.get(table, (F.crc32(w.cast("binary")) % size).cast("int"))[w]


def _scored(units: DataFrame, weights: dict[str, float], other: float, threshold: float) -> DataFrame:
    """``path, is_licence, licence, score, long`` of units that are near enough to a template."""
    squares = _squares(weights)
    short = sorted({w for _, n, words in _template_words() if n < LINES for w in words})
    # Sums go by the words in order, so that the same unit has the same score in any plan.
    add = lambda total, w: total + squares(w)
    mass = F.aggregate(F.array_sort("known"), F.lit(0.0), add)
    line_mass = F.aggregate(F.filter("known", lambda w: w.isin(short)), F.lit(0.0), add)
    units = units.withColumn("sums", F.explode(F.array(F.struct(mass.alias("mass"), line_mass.alias("line_mass")))))
    units = units.withColumn("length", F.col("sums.mass") + F.col("others") * other**2)
    # The cosine with any template is at most the root of the share that its words can have, and of
    # the shorter's part of the longer.
    least = threshold**2 * (1 - 1e-9)
    units = units.where(F.col("sums.mass") >= least * F.col("length"))
    templates = F.array(*(
        F.struct(
            F.lit(name).alias("licence"), F.lit(n >= LINES).alias("long"), F.split(F.lit(" ".join(words)), " ").alias("words"),
            F.lit(math.fsum(weights[w] ** 2 for w in words)).alias("length"),
        )
        for name, n, words in _template_words()
    ))
    near = F.filter(templates, lambda t: (
        (t["length"] >= least * F.col("length")) & (F.col("length") >= least * t["length"])
        & (t["long"] | (F.col("sums.line_mass") >= least * F.col("length")))
    ))
    pairs = units.withColumn("template", F.explode(near))
    shared = F.array_sort(F.array_intersect("template.words", "known"))
    dot = F.aggregate(shared, F.lit(0.0), add)
    score = F.round(dot / F.sqrt(F.col("length") * F.col("template.length")), 6)
    pairs = pairs.select("path", "is_licence", "template.licence", "template.long", score.alias("score"))
    return pairs.where(F.col("score") >= threshold)


def scan(files: DataFrame, path: str = "path", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``path, licence, basis, score, directory`` for every distinct path.

    ``basis`` is ``own`` (a line of the file, a licence file as a whole, or the leading comment of
    another) or ``inherited`` from ``directory``; all but the path are null where no licence is
    known. The best template counts, ties by the licence's name; that all rights are reserved counts
    only where the file has no licence of several lines. A directory's licence is that of the licence files in it, the best
    of several; a path that ends in ``/`` is the directory's own page and counts as one of them.

    Rows with the same path are one file. A null path is left out, a null or empty text has no
    licence of its own. Other columns change nothing.

    Texts are read three times and never shuffled; what is collected is one weight per template word, so
    it is bounded by the templates. Directories are joined once each, however many files they hold.
    """
    vocabulary = sorted({w for _, _, words in _template_words() for w in words})
    files = files.select(F.col(path).cast("string").alias("path"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    files = files.where("path is not null")
    name = F.regexp_extract("path", "[^/]*$", 0)
    files = files.withColumn("is_licence", name.rlike(LICENCE_FILE) | F.col("path").endswith("/"))
    units = _units(files, vocabulary)
    count = files.agg(F.sum(F.size(_texts(files)))).first()[0] or 0
    weights = _weights(units, vocabulary, count)
    scored = _scored(units, weights, math.log1p(count) / 2 + 1, threshold)
    found = F.struct((-F.col("score")).alias("minus"), "licence")
    said = F.min(F.when(F.col("licence") != RESERVED, found))
    best = F.when(F.max("long"), said).otherwise(F.min(found)).alias("best")
    own = stored(scored.groupBy("path", "is_licence").agg(best), "licences")  # read twice below

    directory = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    directory = F.when(F.instr("path", "/") > 0, directory).otherwise(F.lit(""))
    holders = own.where("is_licence").withColumn("above", directory).groupBy("above").agg(F.min("best").alias("given"))
    paths = files.select("path").distinct().withColumn("directory", directory)
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    above = F.array_distinct(F.concat(F.array(F.lit("")), above))
    places = paths.select("directory").distinct().withColumn("above", F.explode(above))
    inherited = lookup(places, holders, "above", "inner", right_grouped=True)
    inherited = inherited.groupBy("directory").agg(
        F.max_by(F.struct("above", "given"), F.length("above")).alias("from")
    )
    rows = lookup(paths, own.select("path", "best"), "path", right_grouped=True)
    rows = lookup(rows, inherited, "directory", right_grouped=True)
    mine = F.col("best").isNotNull()
    found = F.coalesce("best", "from.given")
    return rows.select(
        "path",
        found["licence"].alias("licence"),
        F.when(mine, "own").when(F.col("from").isNotNull(), "inherited").alias("basis"),
        (-found["minus"]).alias("score"),
        F.when(~mine, F.col("from.above")).alias("directory"),
    )
