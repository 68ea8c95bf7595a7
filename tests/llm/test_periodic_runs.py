import hashlib
import random
import zlib

import numpy as np
from helpers import by_id, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import periodic_runs, queries
from starloom.llm.periodic_runs import collapse, find_runs

SF = "/root/testdata/sf0.001"


def brute(words, min_words=6, min_exponent=4):
    """Every period of its own: stretches of words that equal the one a period later."""
    n, found = len(words), {}
    seen = {}
    codes = np.array([seen.setdefault(w, len(seen)) for w in words])
    for q in range(1, n // min_exponent + 1):
        breaks = np.concatenate([[-1], np.flatnonzero(codes[:-q] != codes[q:]), [n - q]])
        for i in np.flatnonzero(np.diff(breaks) - 1 + q >= max(min_words, min_exponent * q)).tolist():
            found.setdefault((int(breaks[i]) + 1, int(breaks[i + 1]) + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _in_order(runs):
    return sorted(runs, key=lambda r: (r[0], r[2]))


def dropped(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=60), max_size=4))
def test_two_words(texts):
    assert find_runs(texts) == [_in_order(brute(t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 7)), max_size=7),
    st.integers(1, 8),
    st.integers(2, 5),
)
def test_powers(parts, min_words, min_exponent):
    words = [w for part, times in parts for w in part * times]
    found = find_runs([words, words[::-1]], min_words, min_exponent)
    assert found == [_in_order(brute(t, min_words, min_exponent)) for t in (words, words[::-1])]
    assert collapse(words, found[0]) == dropped(words, found[0])


def test_all_texts_of_a_few_words():
    for n in range(15):
        texts = [[code >> i & 1 for i in range(n)] for code in range(1 << n)]
        if n > 11:
            texts = random.Random(n).sample(texts, 800)
        assert find_runs(texts) == [_in_order(brute(t)) for t in texts]


def test_long_texts():
    """In time close to their length: one word, one long period, a Fibonacci word, a common phrase."""
    n = 100_000
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    rng = random.Random(3)
    phrase = [w for _ in range(20_000) for w in ("u", "v", "w", "x", "y", f"z{rng.randint(0, 5)}")]
    one, period, fibonacci, phrases = find_runs([["a"] * n, list(range(n // 5)) * 5, b, phrase])
    assert one == [(0, n, 1)]
    assert period == [(0, n, n // 5)]
    assert fibonacci == []
    assert all(phrase[s : s + p] == phrase[s + p : s + 2 * p] and length >= 4 * p for s, length, p in phrases)


def tail(doc_id, words):
    """The rewritten words as the contract says it, word by word."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = tail(doc_id, (text or "").encode().split())
    runs = _in_order(brute(words))
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    digests = (hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(dropped(words, runs))))
    return doc_id, len(runs), s, n, q, n and 1000 * n // q, *digests


def test_query(spark):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ours = by_id(queries.op12_periodic_runs(spark, SF), *names)
    assert ours == sorted(expected(r.doc_id, r.text) for r in rows)
    assert any(r[1] for r in ours)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TOGETHER", 50)
    six = "x y " * 6
    rows = [(1, None), (2, ""), (3, six), (3, six), (None, "a " * 6 + "é " * 7), (5, " \t\n"), (6, "w " * 300_000), (7, "a\x0bb\x0c" * 4)]
    found = periodic_runs.periodic_runs(docs(spark, rows)).collect()
    ours = sorted((r.doc_id or 0, [tuple(x) for x in r.runs], r.collapsed) for r in found)
    assert ours == [
        (0, [(0, 6, 1), (6, 7, 1)], "a é"), (1, [], ""), (2, [], ""), (3, [(0, 12, 2)], "x y"), (3, [(0, 12, 2)], "x y"),
        (5, [], ""), (6, [(0, 300_000, 1)], "w"), (7, [(0, 8, 2)], "a b"),
    ]
    assert periodic_runs.periodic_runs(docs(spark, [])).count() == 0
