import random

import pytest
from helpers import by_id, docs

from starloom.llm import decontamination as D
from starloom.llm import queries

SF = "/root/testdata/sf0.001"
ITEMS = "item_id bigint, text string, doc_id string"


def distance(pattern, text):
    """Least edit distance of the pattern to any part of the text, and its first end."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min((d, j) for j, d in enumerate(row))


def brute(rows, items, percent):
    found = []
    for i, text in rows:
        for item_id, item in items:
            item = D.normalised(item or "")
            if item:
                d, end = distance(item, D.normalised(text or ""))
                if d <= D.budget(item, percent):
                    found.append((i, item_id, d, end))
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))


def found(spark, rows, items, percent):
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    return by_id(D.leaks(docs(spark, rows), bench, percent), "doc_id", "item_id", "distance", "end")


def test_myers_equals_the_table():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choices("abc ", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc ", k=rng.randint(0, 60)))
        text = text[:30] + "".join(c for c in pattern if rng.random() > 0.1) + text[30:]
        assert D.Myers(pattern).best(text) == distance(pattern, text)


def test_against_every_pair(spark, monkeypatch):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choices("abcde fg\n", k=n))
    items = [(i, text(rng.randint(5, 90))) for i in range(12)]
    rows = []
    for i in range(90):
        item = rng.choice(items)[1]
        edited = "".join(rng.choice(["", "x", c + "y"]) if rng.random() < 0.07 else c for c in item)
        rows.append((i, text(40) + edited.upper() + text(40)))
    expected = brute(rows, items, 10)
    assert 20 < len(expected) < 90
    assert found(spark, rows, items, 10) == expected
    monkeypatch.setattr(D, "BLOCK_CHARS", 200)  # several blocks
    assert found(spark, rows, items, 10) == expected


def test_odd_rows(spark):
    item = "The quick brown fox jumps over the lazy dog"
    items = [(1, item), (1, item), (2, None), (3, ""), (4, " \n"), (None, "zebra crossing")]
    rows = [
        (1, None), (2, ""), (3, item), (3, item), (None, "x " + item.replace(" ", "\n ") + "İ"), (5, "a " * 100_000 + item),
        (6, "zebra  CROSSING"), (7, "zebra crosing"), (8, item[:-4]), (9, item[:-3]),
    ]
    expected = brute([r for r in rows if r[0] != 5], items[1:], 8) + [(5, 1, 0, 200_000 + len(item))]
    assert found(spark, rows, items, 8) == sorted(expected, key=lambda r: tuple((v is not None, v) for v in r))
    assert found(spark, [], items, 8) == []
    assert found(spark, rows, [], 8) == []


def test_clean_keeps_all_columns(spark):
    item = "The quick brown fox jumps over the lazy dog"
    frame = docs(spark, [(1, f"so {item}!"), (2, "nothing"), (None, None)])
    bench = spark.createDataFrame([(1, item, "x")], ITEMS)
    kept = D.clean(frame, bench)
    assert kept.schema == frame.schema
    assert by_id(kept, "doc_id") == [(None,), (2,)]


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = by_id(queries.op4_decontamination(spark, SF), "doc_id", "item_id", "distance")
    exact = {(i, k) for i, t in rows for k, item in items if D.normalised(item) in D.normalised(t)}
    assert exact and exact == {(i, k) for i, k, d in got if d == 0}
    few = {i for i, *_ in got}
    near = [r for r in rows if r[0] in few or r[0] % 40 == 0]
    near = [r for r in near if len(r[1]) < 700]
    ids = {i for i, _ in near}
    assert [r[:3] for r in brute(near, items, D.PERCENT)] == [r for r in got if r[0] in ids]


def test_items_need_whole_numbers_as_ids(spark):
    bench = spark.createDataFrame([("a1", "some item")], "item_id string, text string")
    with pytest.raises(TypeError, match="whole numbers"):
        D.clean(docs(spark, [(1, "x")]), bench)


def test_several_blocks_give_what_one_gives(spark, monkeypatch):
    items = [(i, f"item number {i} of a long and winding list of items", "x") for i in range(40)]
    bench = spark.createDataFrame(items, ITEMS)
    frame = docs(spark, [(i, f"here is {items[i][1]} again") for i in range(40)] + [(99, "nothing")])
    one = by_id(D.leaks(frame, bench), "doc_id", "item_id", "distance", "end")
    monkeypatch.setattr(D, "BLOCK_CHARS", 1000)
    assert by_id(D.leaks(frame, bench), "doc_id", "item_id", "distance", "end") == one
    assert by_id(D.clean(frame, bench), "doc_id") == [(99,)]
