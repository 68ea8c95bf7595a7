import hashlib
import random

import numpy as np
import pytest
from helpers import by_id, docs

from starloom.llm import queries, shards, suffix_dedup

WIDTH = suffix_dedup.WINDOW


def brute(rows):
    """(id, kept bytes, spans) by looking at every string of every document."""
    first = {}
    datas = [(shards.NULL_ID if i is None else i, (t or "").encode()) for i, t in rows]
    for i, data in datas:
        for at in range(len(data) - WIDTH + 1):
            string = data[at : at + WIDTH]
            first[string] = min(first.get(string, i), i)
    out = []
    for (shown, _), (i, data) in zip(rows, datas):
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - WIDTH + 1):
            if first[data[at : at + WIDTH]] < i:
                gone[at : at + WIDTH] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        out.append((shown, len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[4]))


def found(spark, rows):
    df = suffix_dedup.cut(docs(spark, rows))
    rows = [(*r[:4], bytes(r[4])) for r in by_id(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[4]))


def passages(seed, count=120, alphabet="abcdé \0"):
    """Documents put together from few passages, whole or in part, with noise between."""
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choices(alphabet, k=n))
    known = [text(rng.randint(20, 300)) for _ in range(12)]
    rows = []
    for i in range(count):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(known)
            cut = rng.randint(0, len(p))
            parts.append(rng.choice([p, p[cut:], p[:cut], text(rng.randint(0, 90)), "ab" * rng.randint(0, 80)]))
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_every_string(spark, monkeypatch, seed):
    monkeypatch.setattr(shards, "SHARD_BYTES", 3000)
    rows = passages(seed)
    assert found(spark, rows) == brute(rows)


def test_split_arrays_and_spread_anchors(spark):
    """Small limits, so that arrays are merged and anchors are widened or spread."""
    rows = passages(3)
    lists = []
    for i, t in rows:
        data = t.encode()
        lists.append((i, data))
    before = suffix_dedup.WIDENED, suffix_dedup.SPREAD, suffix_dedup.ARRAY_BYTES
    for *limits, size in ((1, 3, 1 << 20), (255, 255, 400), (2, 2, 300), (1, 255, 1 << 20), (2, 4, 300), (2, 255, 250)):
        suffix_dedup.WIDENED, suffix_dedup.SPREAD, suffix_dedup.ARRAY_BYTES = *limits, size
        try:
            assert _in_memory(lists, 8) == brute(rows)
        finally:
            suffix_dedup.WIDENED, suffix_dedup.SPREAD, suffix_dedup.ARRAY_BYTES = before


def test_widened_anchors_send_each_string_once_and_meet_by_context():
    """Fragments of one anchor in many contexts: as many groups as there are contexts."""
    rng = random.Random(8)
    for _ in range(60):  # until the phrase is an anchor
        phrase = rng.randbytes(20)
        data = b"".join(rng.randbytes(60) + phrase + rng.randbytes(60) for _ in range(200))
        padded = suffix_dedup._padded(data)
        runs = suffix_dedup.anchor_runs(padded, np.array([0]), np.array([len(data)]))
        if np.unique(runs.key, return_counts=True)[1].max() >= 150:
            break
    cut = suffix_dedup._contexts(padded, runs)
    covered = np.sort(np.concatenate([np.arange(s, s + n) for s, n in zip(cut.start, cut.count)]))
    assert np.array_equal(covered, np.arange(len(data) - suffix_dedup.WINDOW + 1))
    assert np.unique(runs.key, return_counts=True)[1].max() >= 150
    assert np.unique(cut.key, return_counts=True)[1].max() <= 2


def test_counts_as_bytes():
    counts = np.arange(1, 100_000)
    codes = shards.coded(counts)
    back = shards._COUNTS[codes]
    assert (np.diff(codes.astype(int)) >= 0).all() and (back <= counts).all() and (back > counts * 0.9).all()
    assert np.array_equal(back[:128], counts[:128])
    assert shards.coded(np.array([10**9])) == 255


def _in_memory(lists, per_shard):
    """The tasks' functions one after the other, without Spark."""
    made = []
    for n in range(0, len(lists), per_shard):
        part = lists[n : n + per_shard]
        ends = np.cumsum([len(d) for _, d in part])
        starts = ends - [len(d) for _, d in part]
        ids = np.array([i for i, _ in part])
        made.append(shards.Shard(n, ids, np.zeros(len(part), bool), starts, ends, b"".join(d for _, d in part), b""))
    buckets = 3
    keys = [suffix_dedup._keys(s) for s in made]
    unique, times = np.unique(np.concatenate(keys), return_counts=True)
    fragments = [
        suffix_dedup._Fragments(s, times[np.searchsorted(unique, k)]) for s, k in zip(made, keys)
    ]

    def exchange(sent, answer):
        mail = {}
        for n, messages in enumerate(sent):
            for b, data in messages:
                mail.setdefault(b, []).append((n, data))
        replies = [{} for _ in made]
        for b, own in mail.items():
            for (n, _), reply in zip(own, answer([d for _, d in own])):
                replies[n][b] = reply
        return replies

    least = exchange([f.ask(buckets) for f in fragments], suffix_dedup._least)
    first = [f.first(r, buckets) for f, r in zip(fragments, least)]
    masks = exchange([f.messages(x, buckets) for f, x in zip(fragments, first)], suffix_dedup._answer)
    out = []
    for s, f, x, m in zip(made, fragments, first, masks):
        bits = np.frombuffer(b"".join(shards.expand(m[b]) for b in sorted(m)), np.uint64)
        gone = suffix_dedup._removed(f, x, bits, len(s.text))
        data = np.frombuffer(s.text, np.uint8)
        for i, a, e in zip(s.ids.tolist(), s.starts.tolist(), s.ends.tolist()):
            own = gone[a:e]
            spans = int(np.count_nonzero(np.diff(own.astype(int), prepend=0) == 1))
            out.append((i, e - a, int(own.sum()), spans, data[a:e][~own].tobytes()))
    return sorted(out)


def _spread_strings(monkeypatch, strings):
    """Strings as two documents each, every anchor spread; the fragments of one shard of them all."""
    monkeypatch.setattr(suffix_dedup, "WIDENED", 2)
    monkeypatch.setattr(suffix_dedup, "SPREAD", 2)
    data = b"".join(s for s in strings for _ in (0, 1))
    ends = np.arange(1, 2 * len(strings) + 1) * WIDTH
    ids = np.arange(len(ends))
    shard = shards.Shard(0, ids, np.zeros(len(ends), bool), ends - WIDTH, ends, data, b"")
    return suffix_dedup._Fragments(shard, np.full(len(suffix_dedup._keys(shard)), 2))


def test_spread_strings_fill_the_buckets(monkeypatch):
    rng = random.Random(4)
    fragments = _spread_strings(monkeypatch, [rng.randbytes(WIDTH) for _ in range(4000)])
    asked = {b: int(np.frombuffer(shards.expand(m), np.int64, 1)[0]) for b, m in fragments.ask(8)}
    assert sum(asked.values()) == 4000
    assert sorted(asked) == list(range(8)) and max(asked.values()) < 2 * 4000 / 8


def test_spread_strings_with_equal_low_bits_stay_apart(monkeypatch):
    rng = random.Random(5)
    count = 300_000
    data = rng.randbytes(WIDTH * count)
    starts, one = np.arange(count) * WIDTH, np.ones(count, np.int64)
    runs = suffix_dedup.Runs(starts, one, np.zeros(count, np.uint64), starts)
    low = suffix_dedup._singles(suffix_dedup._padded(data), runs).key.astype(np.uint32)
    order = np.argsort(low, kind="stable")
    same = np.flatnonzero(low[order][1:] == low[order][:-1])
    assert len(same)
    monkeypatch.setattr(suffix_dedup, "WIDENED", 2)
    monkeypatch.setattr(suffix_dedup, "SPREAD", 2)
    for n in same.tolist():
        a, b = (data[starts[i] : starts[i] + WIDTH] for i in order[n : n + 2].tolist())
        rows = _in_memory([(0, a), (1, a), (2, b), (3, b)], 1)
        assert [(i, kept) for i, *_, kept in rows] == [(0, a), (1, b""), (2, b), (3, b"")]


def test_long_text_in_segments():
    rng = random.Random(9)
    text = "".join(rng.choices("abcdef ", k=5000))
    lists = [(0, text[1000:3000].encode()), (1, text.encode()), (2, text[:200].encode() + text[2900:].encode())]
    segment, suffix_dedup.SEGMENT = suffix_dedup.SEGMENT, 700
    try:
        assert _in_memory(lists, 2) == brute([(i, d.decode()) for i, d in lists])
    finally:
        suffix_dedup.SEGMENT = segment


def test_suffix_order_and_prefixes():
    rng = random.Random(6)
    for _ in range(150):
        texts = [bytes(rng.choices(b"ab\0", k=rng.randint(1, 84))) for _ in range(rng.randint(1, 9))]
        texts += rng.choices(texts, k=2)
        made = suffix_dedup.Suffixes(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]))
        all_ = [t[i:] for t in texts for i in range(len(t))]
        order = sorted(range(len(all_)), key=lambda i: (all_[i], i))
        assert made.order.tolist() == order
        for n in range(1, len(order)):
            a, b = all_[order[n - 1]], all_[order[n]]
            same = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert made.common[n] == same


def test_odd_rows(spark):
    long = "A passage of more than fifty bytes that several documents have. "
    rows = [
        (5, None), (6, ""), (1, long), (1, long), (7, "x" + long), (None, long + "y"), (None, long + "y"),
        (0, long[3:]), (9, "short"), (9, "short"), (-4, "é" * 60), (3, "é" * 40), (8, "a" * 300_000), (2, "a" * 70),
    ]
    assert found(spark, rows) == brute(rows)
    assert suffix_dedup.cut(docs(spark, rows).limit(0)).count() == 0


def test_carried_columns_and_whole_characters(spark):
    rows = [(i, "ñandú " * 9 + "é" * n + "w") for i, n in enumerate((30, 26, 31))]
    df = suffix_dedup.cut(docs(spark, rows), carry=["n_tokens", "component_id"], whole_characters=True)
    got = df.collect()
    assert {r.doc_id for r in got} == {0, 1, 2}
    for r in got:
        bytes(r.kept).decode()
        assert (r.n_tokens, r.component_id) == ("x", 7)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected = [(i, n, r, s, hashlib.sha256(k).hexdigest()) for i, n, r, s, k in brute(rows)]
    df = queries.op3_suffix_dedup(spark, sf)
    assert by_id(df, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
