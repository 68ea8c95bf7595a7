import random

import numpy as np
import pytest
from helpers import by_id, docs

from starloom.llm import components, jaccard_join, queries, shards

SF = "/root/testdata/sf0.001"


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    size = min(n, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, n, percent):
    """(id, size, component) over all pairs; null ids sort last."""
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = label[i], label[j]
                label = [y if v == x else v for v in label]
    ids = [shards.NULL_ID if i is None else i for i, _ in rows]
    least = {}
    for v, i in zip(label, ids):
        least[v] = min(least.get(v, i), i)
    show = lambda i: None if i == shards.NULL_ID else i
    return [(rows[k][0], len(sets[k]), show(least[label[k]])) for k in range(len(rows))]


def variants(seed, groups=12, size=8):
    """Texts with edits around the threshold, from few words, so that n-grams are frequent."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.randint(1, 120))
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                at = rng.randrange(len(own) + 1)
                own[at : at + rng.randint(0, 1)] = rng.choices(words, k=rng.randint(0, 2))
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    return rows


def found(spark, rows, n, percent):
    df = jaccard_join.classes(docs(spark, rows), n, percent)
    return by_id(df, "doc_id", "n_shingles", "component_id")


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 1), (5, 80, 2)])
def test_against_all_pairs(spark, monkeypatch, n, percent, seed):
    monkeypatch.setattr(shards, "SHARD_BYTES", 2000)
    rows = variants(seed)
    expected = brute(rows, n, percent)
    assert len({c for *_, c in expected}) < len(rows)  # there are links
    assert found(spark, rows, n, percent) == sorted(expected)


def test_blocks_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 6)
    monkeypatch.setattr(jaccard_join, "PART", 3)
    rows = variants(3, groups=4, size=20)
    assert found(spark, rows, 3, 90) == sorted(brute(rows, 3, 90))


def test_links_connect_what_all_links_connect():
    rng = random.Random(4)
    for _ in range(30):
        rows = variants(rng.random(), groups=3, size=6)
        words = jaccard_join._Words()
        sets = [jaccard_join.grams(t.encode(), 3, words) for _, t in rows]
        pairs = jaccard_join.links(sets, np.zeros(len(sets), int), 90)
        label = list(range(len(rows)))
        for a, b in pairs:
            x, y = label[a], label[b]
            label = [y if v == x else v for v in label]
        same = {(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(len(rows)) if label[i] == label[j]}
        truth = {r[0]: r[2] for r in brute(rows, 3, 90)}
        assert same == {(a, b) for a in truth for b in truth if truth[a] == truth[b]}


def test_one_document_of_each_component_is_kept(spark):
    rows = variants(5)
    df = jaccard_join.classes(docs(spark, rows), 5, 80, carry=["n_tokens", "component_id"], with_text=True)
    got = df.toPandas()
    kept = got[got["kept"]]
    assert sorted(kept.doc_id) == sorted({c for *_, c in brute(rows, 5, 80)})
    assert dict(zip(got.doc_id, got.text)) == dict(rows)
    assert set(got.n_tokens) == {"x"}


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "One two"), (9, "one  TWO"), (4, "one two"), (None, "a b c d"),
        (None, "a b c d"), (5, "x y"), (6, "x y"), (7, "É b c"), (8, "é b c"), (11, "w " * 200_000),
        (10, "w w w"), (12, "p q r s"), (None, "p q r s"),
    ]
    key = lambda r: tuple((v is not None, v) for v in r)
    assert found(spark, rows, 3, 90) == sorted(brute(rows, 3, 90), key=key)
    assert jaccard_join.classes(docs(spark, rows).limit(0), 3, 90).count() == 0


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    label = {v: v for e in edges for v in e}
    for a, b in edges:
        x, y = label[a], label[b]
        label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
    loops = {a for a, b in edges if a == b} - {v for a, b in edges if a != b for v in (a, b)}
    expected = sorted((k, v) for k, v in label.items() if k not in loops)
    df = components.components(spark.createDataFrame(edges, "x long, y long"), "x", "y")
    assert by_id(df, "node", "root") == expected
    assert components.components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = by_id(queries.op7_jaccard_join(spark, SF), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute(rows, 3, 90))
