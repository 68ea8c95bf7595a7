import math
import random
import re
import time
from collections import Counter

import duckdb

from pyspark.sql import functions as F

from starloom.llm import licenses, oracle, queries

TEMPLATES = [(name, sorted(set(re.findall("[a-z0-9]+", text.lower())))) for name, text in licenses.TEMPLATES]
VOCABULARY = {w for _, words in TEMPLATES for w in words}


def words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text)
    return set(re.findall("[a-z0-9]+", lower))


def brute(files, threshold=licenses.THRESHOLD):
    units = []
    for path, text in files:
        name = path.rsplit("/", 1)[-1]
        licence_file = bool(re.match(licenses.LICENCE_FILE, name)) or path.endswith("/")
        own = set((text or "").split("\n")) | ({text or ""} if licence_file else set())
        units += [(path, licence_file, words(u)) for u in own]
    df = Counter(w for _, _, ws in units for w in ws & VOCABULARY)
    weight = {w: math.log((1 + len(units)) / (1 + df[w])) + 1 for w in VOCABULARY}
    other = math.log1p(len(units)) / 2 + 1
    best = {}
    for path, licence_file, ws in units:
        length = sum(weight[w] ** 2 for w in ws & VOCABULARY) + len(ws - VOCABULARY) * other**2
        for name, template in TEMPLATES:
            dot = sum(weight[w] ** 2 for w in ws & set(template))
            if dot:
                score = round(dot / math.sqrt(length * sum(weight[w] ** 2 for w in template)), 6)
                if score >= threshold:
                    key = path, licence_file
                    best[key] = min(best.get(key, (1, "")), (-score, name))
    given = {}
    for (path, licence_file), found in best.items():
        if licence_file:
            folder = path.rsplit("/", 1)[0] if "/" in path else ""
            given[folder] = min(given.get(folder, (1, "")), found)
    out = []
    for path in {p for p, _ in files}:
        mine = min((v for (p, _), v in best.items() if p == path), default=None)
        if mine:
            out.append((path, mine[1], "own", -mine[0], None))
            continue
        folder = path.rsplit("/", 1)[0] if "/" in path else ""
        parts = folder.split("/")
        above = ["", *("/".join(parts[:n]) for n in range(1, len(parts) + 1))]
        near = max((a for a in above if a in given), key=len, default=None)
        out.append((path, None, None, None, None) if near is None else (path, given[near][1], "inherited", -given[near][0], near))
    return sorted(out)


def found(spark, files):
    df = spark.createDataFrame([(p, t, "x", 1) for p, t in files], "path string, text string, licence string, above int")
    rows = licenses.scan(df.repartition(3)).select("path", "licence", "basis", "score", "directory").collect()
    return sorted(tuple(r) for r in rows)


def same(ours, theirs):
    """Scores may differ in the sixth place, where sums went in another order."""
    assert [(*r[:3], r[4]) for r in ours] == [(*r[:3], r[4]) for r in theirs]
    assert all(a[3] == b[3] or abs(a[3] - b[3]) < 2e-6 for a, b in zip(ours, theirs))


def tree(seed):
    rng = random.Random(seed)
    prose = lambda: " ".join(rng.choices("the of and work cat dog version under house 2 x y z".split(), k=rng.randint(1, 12)))
    files = []
    for n in range(150):
        folder = "/".join(rng.choices("abc", k=rng.randint(0, 4)))
        name = rng.choice(["LICENSE", "licence.txt", "COPYING", "", "main.c", "x.py", "y.md"]) or rng.choice(["", "n"])
        notice = rng.choice(licenses.TEMPLATES)[1]
        lines = [prose() for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.4:
            lines.insert(rng.randint(0, len(lines)), rng.choice(["", "# ", "/* see "]) + notice.upper() + rng.choice(["", "."]))
        if rng.random() < 0.2:
            lines = notice.replace(" ", "\n", 2).split("\n")
        files.append((f"{folder}/{name}" if folder else name or f"f{n}", "\n".join(lines)))
    return files


def test_against_one_file_at_a_time(spark):
    files = list({p: (p, t) for p, t in tree(1)}.values())
    expected = brute(files)
    assert {r[2] for r in expected} == {"own", "inherited"}
    same(found(spark, files), expected)


def test_odd_rows(spark):
    notice = licenses.TEMPLATES[0][1]
    files = [
        (None, notice), ("", notice), ("a", None), ("a/b", ""), ("a/LICENSE", notice), ("a/LICENSE", notice), ("a//c", "x"),
        ("a/b/c/d", "x " * 100_000), ("/", "Released under the MIT License."), ("d/" * 2000 + "e", "x"), ("z/", "All rights reserved"),
    ]
    same(found(spark, files), brute([f for f in files if f[0] is not None]))
    assert found(spark, []) == []
    same(found(spark, [("a", None)]), brute([("a", None)]))


def test_sql_says_the_same():
    pages = [(n, f"http://{p}", t.replace("\n", "<br>")) for n, (p, t) in enumerate({p: (p, t) for p, t in tree(3)}.values())]
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    rows = db.execute(oracle.all_sql()["op8_license_scan"]).fetchall()
    expected = brute([(u.split("://")[1], t.replace("<br>", "\n")) for _, u, t in pages])
    same(sorted(rows), expected)


MIT = """MIT License

Copyright (c) 2021 Some Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
GNU = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def test_whole_texts_and_headers(spark):
    apache, gpl, lgpl, mpl = (licenses._text(n) for n in ("Apache-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0"))
    bsd = "Copyright (c) 1999, Foo\nAll rights reserved.\n\n" + licenses._REDISTRIBUTION + licenses._NO_ENDORSEMENT + licenses._DISCLAIMER
    marked = lambda mark: "\n".join(mark + x for x in GNU.split("\n"))
    code = "int x = 1;\nreturn x;"
    files = [
        ("m/LICENSE", MIT), ("m/src/a.c", code), ("a/LICENSE.txt", apache + "\nCopyright 2020 Foo"), ("a/x", "x"), ("g/COPYING", gpl), ("g/d/e/f", "x"),
        ("l/COPYING.LESSER", lgpl), ("l/x", ""), ("p/LICENSE", mpl), ("p/x", None), ("b/LICENSE", bsd), ("b/x", "x"),
        ("n/LICENSE", "All rights reserved."), ("n/x", "x"), ("o/README", MIT.replace("\n", " ").split("Permission")[0]),
        ("s/1.py", "#!/usr/bin/python\n" + marked("# ") + "\n\nimport os"), ("s/2.c", f"\n/*\n{GNU}\n */\n{code}"),
        ("s/3.js", marked("// ") + f"\n{code}"), ("s/4.h", "/* Copyright (C) 2001 Foo\n *\n" + marked(" * ") + f"\n */\n{code}"),
        ("s/5.py", "# " + "\n# ".join(MIT.split("\n")) + "\nimport os"), ("s/6.c", "// only a comment\n// of two lines\n" + code),
    ]
    expected = {
        "m/LICENSE": "MIT", "m/src/a.c": "MIT", "a/LICENSE.txt": "Apache-2.0", "a/x": "Apache-2.0", "g/COPYING": "GPL-3.0",
        "g/d/e/f": "GPL-3.0", "l/COPYING.LESSER": "LGPL-3.0", "l/x": "LGPL-3.0", "p/LICENSE": "MPL-2.0", "p/x": "MPL-2.0",
        "b/LICENSE": "BSD-3-Clause", "b/x": "BSD-3-Clause", "n/LICENSE": "Proprietary", "n/x": "Proprietary", "o/README": None,
        "s/1.py": "GPL-2.0", "s/2.c": "GPL-2.0", "s/3.js": "GPL-2.0", "s/4.h": "GPL-2.0", "s/5.py": "MIT", "s/6.c": None,
    }
    got = found(spark, files)
    assert {r[0]: r[1] for r in got} == expected
    assert {r[0]: r[4] for r in got if r[2] == "inherited"} == {
        "m/src/a.c": "m", "a/x": "a", "g/d/e/f": "g", "l/x": "l", "p/x": "p", "b/x": "b", "n/x": "n",
    }


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("url", "html").collect()
    files = [(re.search("://([^?#]*)", r.url)[1], re.sub("<[^>]*>", "\n", r.html)) for r in rows]
    got = queries.op8_license_scan(spark, sf).select("path", "licence", "basis", "score", "directory").collect()
    same(sorted(tuple(r) for r in got), brute(files))


def test_html_lines_is_what_the_expression_says(spark):
    rng = random.Random(3)
    pages = ["".join(rng.choices("<>ab\n", k=rng.randint(0, 14))) for _ in range(2000)] + ["", "<", ">", "a>b<c"]
    frame = spark.createDataFrame([(p,) for p in pages], "html string")
    got = frame.select("html", licenses.html_lines(F.col("html"))).collect()
    assert [r[1] for r in got] == [re.sub("<[^>]*>", "\n", r[0]) for r in got]
    assert spark.sql("select cast(null as string) html").select(licenses.html_lines(F.col("html"))).first()[0] is None


def test_long_runs_take_time_close_to_their_length(spark):
    n = 200_000
    begun = time.monotonic()
    texts = ["# a" + " " * n + "b\ncode", "# a" + "\n" * n + "code", "# " + "*" * n, "/*" * (n // 2), "<!--" + "-" * n, "x" * n]
    assert len(found(spark, [(f"f{i}", t) for i, t in enumerate(texts)])) == len(texts)
    pages = spark.createDataFrame([("<" * n,), ("<a" * n + ">",), (">" * n,)], "html string")
    assert [len(r[0]) for r in pages.select(licenses.html_lines(F.col("html"))).collect()] == [n, 1, n]
    assert time.monotonic() - begun < 60
