"""Runs of repeating words: stretches that one passage fills several times over.

Suffixes of the word sequences are sorted by doubling prefixes, for many texts at once; suffixes that
share too few words with any other of their text are out at once. Common prefixes of neighbours
(Kasai's order) make the tree of LCP intervals, which is walked bottom-up. A node holds its
positions in order, and the word to the left of each is its class. Two positions that meet at a node
and differ in class are a maximal pair: equal for just the node's depth, and to neither side. A
maximal pair whose distance q fits often enough into its length is a run of period q, already as
long as it can be.

Positions of a node no further apart than such a q lie in one stretch of that period, so all have the
same class but, perhaps, the first. That makes the pairs of a position a look at its window, and the
pairs in all no more than the runs' exponents add up to.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.tables import text_batches

#: Words that are sorted together; a longer text is sorted alone.
TOGETHER = 1 << 18

Run = tuple[int, int, int]


def _regroup(rank: np.ndarray, active: np.ndarray, ahead: int) -> np.ndarray:
    """Refine the groups of ``active`` by the ranks ``ahead`` of them; returns who is still tied."""
    first = rank[active]
    keys = first * len(rank) + rank[active + ahead]
    order = np.argsort(keys, kind="stable")
    active, keys, first = active[order], keys[order], first[order]
    place = np.arange(len(active))
    fresh = np.empty(len(active), bool)
    fresh[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
    whole = np.empty(len(active), bool)
    whole[:1] = True
    np.not_equal(first[1:], first[:-1], out=whole[1:])
    starts = np.maximum.accumulate(np.where(fresh, place, 0))
    rank[active] = first + starts - np.maximum.accumulate(np.where(whole, place, 0))
    tied = ~fresh
    tied[:-1] |= ~fresh[1:]
    return active[tied]


def _sorted_suffixes(codes: np.ndarray, text_of: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions that share ``least`` words or more with another of their text, in order.

    Also says which of them share as much with the one before. Texts end in code 0, which no word
    has, so that a tied suffix never reaches the end of its text.
    """
    keys = text_of * (int(codes.max(initial=0)) + 1) + codes
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    fresh = np.append(True, keys[1:] != keys[:-1])
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    tied = ~fresh
    tied[:-1] |= ~fresh[1:]
    active, size = order[tied], 1
    while size < least and len(active):
        step = min(size, least - size)
        active = _regroup(rank, active, step)
        size += step
    members, group = active, rank[active]
    while len(active):
        active = _regroup(rank, active, size)
        size *= 2
    order = np.argsort(rank[members])
    group = group[order]
    return members[order], np.append(False, group[1:] == group[:-1])


def _common_prefixes(codes: list[int], suffixes: list[int], follows: list[bool], least: int) -> list[int]:
    """Words in common with the suffix before, 0 at the start of a group; in the order of the texts."""
    before = {at: suffixes[n - 1] for n, at in enumerate(suffixes) if follows[n]}
    common: dict[int, int] = {}
    previous, size = -2, 0
    for at in sorted(before):
        size = max(size - 1, least) if at == previous + 1 else least
        other = before[at]
        while codes[at + size] == codes[other + size]:
            size += 1
        common[at] = size
        previous = at
    return [common.get(at, 0) for at in suffixes]


def _meet(a: list[int], b: list[int], depth: int, codes: list[int], min_words: int, min_exponent: int, found: dict) -> list[int]:
    """Join two children of a node; their maximal pairs go to ``found`` as runs."""
    if len(a) < len(b):
        a, b = b, a
    reach = depth // (min_exponent - 1)
    for at in b:
        left = codes[at - 1]
        low = bisect_left(a, at - reach)
        if low < len(a) and (start := a[low]) < at and codes[start - 1] != left:
            _note(found, start, at - start, at + depth, min_words)
        for other in a[bisect_right(a, at) : bisect_right(a, at + reach)]:
            if codes[other - 1] == left:
                break
            _note(found, at, other - at, other + depth, min_words)
    for at in b:
        insort(a, at)
    return a


def _note(found: dict, start: int, period: int, stop: int, min_words: int) -> None:
    """Of several periods of one stretch, the smallest counts."""
    if stop - start >= min_words and period < found.get((start, stop), stop):
        found[start, stop] = period


def find_runs(texts: list[list], min_words: int = 6, min_exponent: int = 4) -> list[list[Run]]:
    """``(start, length, period)`` of all runs of each word sequence, by start, then period."""
    vocabulary: dict = defaultdict()
    vocabulary.default_factory = lambda: len(vocabulary) + 1
    # A run of period q is a pair that shares this many words or more, whatever q is.
    least = min(max(min_words - q, (min_exponent - 1) * q) for q in range(1, min_words + 1))
    sizes = np.array([len(words) + 1 for words in texts], np.int64)
    begins = np.cumsum(sizes) - sizes + 1
    codes = np.zeros(int(sizes.sum()) + 1, np.int64)
    for begin, words in zip(begins.tolist(), texts):
        codes[begin : begin + len(words)] = [vocabulary[word] for word in words]
    text_of = np.append(0, np.repeat(np.arange(len(texts)), sizes))
    # The 0 before the first word belongs to no text: one of its own.
    text_of[0] = len(texts)
    suffixes, follows = _sorted_suffixes(codes, text_of, least)
    out: list[list[Run]] = [[] for _ in texts]
    if not len(suffixes):
        return out
    listed = codes.tolist()
    # Before a text comes another one's end, the same for all: each start is a class of its own.
    for begin in begins.tolist():
        listed[begin - 1] = -begin
    order = suffixes.tolist()
    common = _common_prefixes(listed, order, follows.tolist(), least)
    found: dict[tuple[int, int], int] = {}
    waiting: list[tuple[int, list[int]]] = []
    node: list[int] = []
    for at, depth in zip([*order, 0], [*common, 0]):
        while waiting and waiting[-1][0] >= depth:
            above, other = waiting.pop()
            node = _meet(other, node, above, listed, min_words, min_exponent, found)
        if depth:
            waiting.append((depth, node))
        node = [at]
    spots = sorted((start, period, stop) for (start, stop), period in found.items())
    which = np.searchsorted(begins, [s[0] for s in spots], "right") - 1
    for n, (start, period, stop) in zip(which.tolist(), spots):
        out[n].append((start - int(begins[n]), stop - start, period))
    return out


def collapse(words: list, runs: list[Run]) -> list:
    """The words, of every run only those that no run has beyond its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def _groups(texts: list[list]) -> Iterator[tuple[int, int]]:
    """Stretches of texts that are sorted together."""
    begin = size = 0
    for n, words in enumerate(texts):
        if n > begin and size + len(words) > TOGETHER:
            yield begin, n
            begin, size = n, 0
        size += len(words)
    if texts:
        yield begin, len(texts)


def periodic_runs(
    docs: DataFrame,
    min_words: int = 6,
    min_exponent: int = 4,
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, runs, collapsed`` of every whole text.

    Words are what ASCII white space separates. ``runs`` holds ``start, length, period`` in words, by
    start, then period, of every stretch of ``max(min_words, min_exponent * period)`` words or more
    that repeats every ``period`` words, the smallest such, and that no neighbouring word continues.
    ``collapsed`` are the words, joined by a blank, that no run holds beyond its first period.
    ``rewrite(key, words)`` gives the words that are looked at instead of the text's own.

    Null and empty texts have no runs and collapse to the empty text. A row comes out for each row,
    whatever its key, its copies and its other columns. Nothing is shuffled. A task holds one batch
    of rows, and what it sorts is at most ``TOGETHER`` words, or one longer text.
    """
    if min_exponent < 2 or min_words < 1:
        raise ValueError("a run repeats at least once, and has a word")
    docs = text_batches(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = [(value.as_py() or b"").split() for value in batch.column("text").cast(pa.binary())]
            if rewrite:
                texts = [rewrite(i.as_py(), words) for i, words in zip(ids, texts)]
            for begin, end in _groups(texts):
                group = texts[begin:end]
                found = find_runs(group, min_words, min_exponent)
                listed = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                kept = [b" ".join(collapse(words, runs)) for words, runs in zip(group, found)]
                columns = [ids.slice(begin, end - begin), pa.array(listed, _RUNS), pa.array(kept, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return docs.mapInArrow(run, f"doc_id {kind}, runs {runs}, collapsed string")


_RUNS = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
