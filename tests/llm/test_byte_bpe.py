import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import by_id, docs

from starloom.llm import byte_bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def both():
    ranks = byte_bpe.read_ranks(queries.RANKS)
    theirs = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, split_at_spaces=True), theirs


def _ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60))
def test_same_ids_as_the_library(both, text):
    ours, theirs = both
    assert _ids(ours, text) == theirs.encode_ordinary(text)
    ours._at_spaces = False
    assert _ids(ours, text) == theirs.encode_ordinary(text)
    ours._at_spaces = True
    assert ours.decode(*ours.encode([text])) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text("aAbtheionér's 1\n\t", max_size=80))
def test_same_ids_on_few_characters(both, text):
    ours, theirs = both
    assert _ids(ours, text) == theirs.encode_ordinary(text)


def test_every_white_space_and_class(both):
    ours, theirs = both
    for code in [*range(0x3100), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), *range(0xFE00, 0x10010)]:
        text = f"a{chr(code)}b {chr(code)}{chr(code)} c"
        assert _ids(ours, text) == theirs.encode_ordinary(text), hex(code)


def test_very_long_pre_tokens(both):
    ours, theirs = both
    rng = random.Random(1)
    for text in ("a" * 20_000, "".join(rng.choices("abcdeté", k=30_000)), "=-" * 15_000):
        assert _ids(ours, text) == theirs.encode_ordinary(text)


@pytest.mark.parametrize("short", [0, 12, 64])
def test_merges_by_rank_then_position(monkeypatch, short):
    """Against picking the smallest rank, leftmost first, over random small vocabularies."""
    monkeypatch.setattr(byte_bpe, "SHORT", short)
    monkeypatch.setattr(byte_bpe, "WORD", 16)
    rng = random.Random(2)
    for _ in range(200):
        tokens = {bytes([c]) for c in b"abc"}
        while len(tokens) < 40:
            a, b = rng.choices(sorted(tokens), k=2)
            tokens.add(a + b)
        ranks = {t: r for r, t in enumerate(sorted(tokens, key=lambda t: (len(t), rng.random())))}
        merger = byte_bpe.Merger(ranks)
        pieces = [bytes(rng.choices(b"abc", k=rng.randint(1, 30))) for _ in range(40)]
        for piece, ids in zip(pieces, merger.merge(pieces)):
            parts = [piece] if piece in ranks else [piece[i : i + 1] for i in range(len(piece))]
            while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]:
                i = min(pairs)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert ids == np.array([ranks[p] for p in parts], "<u4").tobytes()


def test_pairs():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 60, (900, 2)), axis=0)
    pairs = byte_bpe.Pairs(keys[:, 0], keys[:, 1], np.arange(len(keys)))
    known = {tuple(k): n for n, k in enumerate(keys.tolist())}
    asked = rng.integers(0, 70, (5000, 2))
    assert pairs.look_up(asked[:, 0], asked[:, 1]).tolist() == [known.get(tuple(a), -1) for a in asked.tolist()]
    none = np.zeros(0, np.int64)
    assert byte_bpe.Pairs(none, none, none).look_up(keys[:, 0], keys[:, 1]).max() == -1


def test_memory_is_bounded_and_keeps_what_is_asked_for():
    memory = byte_bpe.Memory(100_000)
    memory.add({"often": b"1234"})
    for n in range(10_000):
        memory.add({f"word {n}": b"1234"})
        assert memory.known({"often"}) == {"often": b"1234"}
        assert len(memory._young) + len(memory._old) <= 100_000 // byte_bpe.ENTRY
    assert memory.known({"word 3", "word 9999"}) == {"word 9999": b"1234"}
    memory.add({"x" * 2000: b""})
    assert memory.known({"x" * 2000}) == {}


def test_few_things_remembered(both, monkeypatch):
    """Ids are the same whatever is remembered and however texts are grouped."""
    theirs = both[1]
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3000)
    monkeypatch.setattr(byte_bpe, "QUEUED", 50)
    ranks = byte_bpe.read_ranks(queries.RANKS)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, split_at_spaces=True)
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abdeèt", k=rng.randint(1, 90))) for _ in range(30)) for _ in range(60)]
    for text in texts + texts:
        assert _ids(encoder, text) == theirs.encode_ordinary(text)


def _expected(theirs, text):
    ids = theirs.encode_ordinary(text or "")
    back = theirs.decode_bytes(ids)
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back).hexdigest()


def test_query(spark, both):
    ours = by_id(
        queries.op10_byte_bpe(spark, SF), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert ours == sorted((r.doc_id, *_expected(both[1], r.text)) for r in rows)


def test_odd_rows(spark, both):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (5, "long " * 100_000)]
    args = queries.RANKS, public_tokenizers.PATTERN
    found = by_id(
        byte_bpe.round_trip(docs(spark, rows), *args),
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256",
    )
    expected = [(i, *_expected(both[1], t)) for i, t in rows]
    assert found == sorted(expected, key=lambda r: (r[0] is not None, r[0] or 0))
    encoded = byte_bpe.encode(docs(spark, rows), *args)
    back = byte_bpe.decode(encoded, *args)
    texts = sorted(bytes(r.text).decode() for r in back.collect())
    assert texts == sorted(t or "" for _, t in rows)
    assert byte_bpe.round_trip(docs(spark, rows).limit(0), *args).count() == 0


def test_large_batch_is_never_whole_in_a_worker(spark, both, monkeypatch):
    """A task holds the texts and ids of one group, not those of all that Spark sends at a time."""
    tasks, frame = [], docs(spark, [(1, "a")])
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, run, schema: tasks.append(run))
    monkeypatch.setattr(byte_bpe, "TOGETHER", 200_000)
    byte_bpe.round_trip(frame, queries.RANKS, public_tokenizers.PATTERN, split_at_spaces=True, with_ids=True)
    texts = [None, "", *("long " * 10_000 + str(n) for n in range(300)), None]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    list(tasks[0](iter([batch.slice(0, 2)])))  # makes the encoder
    tracemalloc.start()
    ids, found = [], []
    for out in tasks[0](iter([batch, batch.slice(0, 0), batch.slice(0, 1)])):
        ids += out.column("doc_id").to_pylist()
        found += zip(*(out.column(c).to_pylist() for c in ("n_tokens", "ids_sha256", "decoded_sha256")))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids == [*range(len(texts)), 0]
    assert [found[n] for n in (0, 1, 2, 301, 302, 303)] == [_expected(both[1], texts[n % 303]) for n in (0, 1, 2, 301, 302, 303)]
    assert most < 12_000_000
