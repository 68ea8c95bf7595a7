from itertools import permutations

import duckdb
import numpy as np
import pytest
from helpers import by_id

from starloom.llm import filter_audit, oracle, queries

DOCS = "doc_id bigint, text string, lang string, part string, mask string, first int"
COLUMNS = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
]
WEIGHTS = {"good_lost": ("quality", 1), "toxic_lost": ("toxic", 1)}


def brute(rows, labels):
    """Every document through every order, one after the other."""
    big = float("inf")
    failed = []
    for i, text, lang in rows:
        text = text or ""
        words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
        fails = ""
        fails += "A" * (len(words) < 200)
        fails += "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text))
        fails += "D" * any(c in "#$%&*|" for c in text)
        own = big if i is None else i
        fails += "E" * any((big if j is None else j) < own and (t or "") == text for j, t, _ in rows)
        good = any(j == i and i is not None and q == 1 for j, q, _ in labels)
        toxic = any(j == i and i is not None and x == 1 for j, _, x in labels)
        failed.append((lang or "", fails, good, toxic))
    out = []
    for part in {p for p, *_ in failed}:
        own = [f for f in failed if f[0] == part]
        orders = ["".join(o) for o in permutations("ABCDE")]
        removed = {}
        for order in orders:
            for step, f in enumerate(order):
                removed[order, step] = [x for x in own if f in x[1] and not set(order[:step]) & set(x[1])]
        for order in orders:
            left = len(own)
            for step, f in enumerate(order):
                gone = removed[order, step]
                left -= len(gone)
                out.append((
                    part, order, step + 1, left, len(gone),
                    sum(f in x[1] and bool(set(order[:step]) & set(x[1])) for x in own),
                    sum(x[1] == f for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone),
                    sum(len(removed[o, o.index(f)]) for o in orders),
                ))
    return sorted(out)


LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, "a b a b a b", "en"), (2, LONG, "en"), (3, LONG, "de"), (4, LONG, None), (5, None, "en"), (6, "", "en"), (6, "", "en"),
    (None, LONG, "en"), (None, "SHOUT", ""), (7, "x # y", "de"), (8, LONG + " |", "fr"), (9, "É" * 40 + "A", "fr"),
    (10, "same " * 300, "en"), (11, "same " * 300, "fr"), (11, "same " * 300, "fr"), (12, "a\x0bb\x0cc d", "en"),
]
LABELS = [(1, 1, 0), (1, 0, 1), (3, 1, 1), (8, None, 1), (10, 0, 0), (None, 1, 1), (99, 1, 1), (11, 1, 0)]


def _frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, lang, "x", "y", 3) for i, t, lang in rows], DOCS).repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def _audit(spark, rows, labels):
    return filter_audit.audit(*_frames(spark, rows, labels), queries.FILTERS, "E", WEIGHTS)


def test_against_applying_every_order(spark):
    assert by_id(_audit(spark, ROWS, LABELS), *COLUMNS) == brute(ROWS, LABELS)


def test_sql_on_odd_rows(spark, tmp_path):
    docs, labels = _frames(spark, ROWS, LABELS)
    db = duckdb.connect()
    for name, frame in (("documents", docs), ("labels", labels)):
        frame.write.parquet(f"{tmp_path}/{name}")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    found = db.execute(f"SELECT {', '.join(COLUMNS)} FROM ({oracle.all_sql()['op11_filter_audit']})").fetchall()
    assert sorted(found) == brute(ROWS, LABELS)


def test_many_copies_and_no_rows(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}", "en") for i in range(300)]
    assert by_id(_audit(spark, rows, []), *COLUMNS) == brute(rows, [])
    assert _audit(spark, [], LABELS).count() == 0
    long = [(1, "word " * 400_000, "en"), (2, "word " * 400_000, "en")]
    assert by_id(_audit(spark, long, []), *COLUMNS) == brute(long, [])


def test_steps():
    orders, steps = filter_audit.removal_steps(3)
    for mask in range(8):
        for o, order in enumerate(orders):
            assert steps[mask, o] == next((s for s, f in enumerate(order) if mask >> f & 1), 3)
    assert np.array_equal(np.sort(orders, 1), np.tile(range(3), (6, 1)))
    with pytest.raises(ValueError):
        filter_audit.audit(None, None, dict.fromkeys("AB"), "A", {})
