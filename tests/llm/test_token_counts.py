import random

import pytest
from helpers import by_id, docs

from starloom.llm import queries, token_counts

SF = "/root/testdata/sf0.001"


def greedy(word, start, inner):
    """Longest piece first, at every place."""
    at, n, pieces = 0, 0, start
    while at < len(word):
        end = next((e for e in range(min(len(word), at + 64), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return None
        at, n, pieces = end, n + 1, inner
    return n


@pytest.fixture(scope="module")
def vocabulary():
    start, inner = token_counts.read_pieces(queries.PIECES)
    return set(start), set(inner)


def test_automaton_on_small_vocabularies():
    rng = random.Random(3)
    for _ in range(300):
        words = ["".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(16)]
        start, inner = set(words[:8]), set(words[8:])
        automaton = token_counts.Automaton(sorted(start), sorted(inner))
        for _ in range(60):
            word = "".join(rng.choices("abcd", [5, 5, 5, 0.3], k=rng.randint(1, 14)))
            assert automaton.pieces(word) == greedy(word, start, inner)


def test_query(spark, vocabulary):
    found = by_id(queries.op5_token_counts(spark, SF), "doc_id", "n_words", "n_unknown", "n_tokens")
    expected = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        lengths = [greedy(w, *vocabulary) for w in r.text.split()]
        expected.append((r.doc_id, len(lengths), lengths.count(None), sum(n or 1 for n in lengths)))
    assert found == sorted(expected)


def test_odd_rows(spark, vocabulary):
    long = "extraordinarily" * 3000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "the cat"), (4, "the cat"), (None, "\u4e00\ue000"), (6, long)]
    found = by_id(
        token_counts.token_counts(docs(spark, rows), queries.PIECES),
        "doc_id", "n_words", "n_unknown", "n_tokens",
    )
    words = sum(greedy(w, *vocabulary) for w in ("the", "cat"))
    assert found == [
        (None, 1, 1, 1), (1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0), (4, 2, 0, words), (4, 2, 0, words),
        (6, 1, 0, greedy(long, *vocabulary)),
    ]
    assert token_counts.token_counts(docs(spark, rows).limit(0), queries.PIECES).count() == 0
