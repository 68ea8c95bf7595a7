"""Remove passages that a document with a smaller id also has, by suffix arrays.

Every string of ``WINDOW`` bytes has an anchor: the 16 bytes inside it with the smallest hash, the
first of them. Equal strings have equal anchors, so strings need only be compared where their
anchors agree. That tells which parts of the texts can be repeated at all and where they meet:

1. Shards of documents count in how many shards each of their anchors occurs.
2. A run of strings with one anchor is a fragment of at most 84 bytes. Of fragments whose anchor is
   shared, hashes go to buckets, once per shard, to learn the smallest id that has each fragment.
   All strings of a fragment are repeated in the documents with other ids.
3. Where the smallest id is, the fragment's text goes to a bucket by anchor, so each distinct
   fragment goes once. The bucket sorts the suffixes of its fragments (Larsson-Sadakane: ranks by
   the first eight bytes, then by ranks eight, sixteen, ... bytes on, for groups that are still
   tied) and takes their common prefixes (Kasai's property, for all positions at once). Neighbours
   that share ``WINDOW`` bytes are one class of equal strings; the smallest id of a class keeps it.
   Fragments of one anchor that are too many for one array lie in several, whose sorted classes
   are merged by binary search.
4. The bucket answers with one bit per string, and each shard cuts its own texts.

An anchor that many shards have would make a large group of fragments. Its runs are cut in two: a
string holds its anchor and, on one side at least, 17 bytes more, which are the same in equal
strings; the 33 bytes take the anchor's place. An anchor that very many shards have may make
large groups even so. Its strings go out one by one, to a bucket by their own hash, so they spread
like any others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import shards as S

WINDOW, GRAM = 50, 16
#: Strings that can share an anchor, and the longest fragment.
SPAN = WINDOW - GRAM + 1
LONGEST = WINDOW + SPAN - 1
WORDS = -(-LONGEST // 8)
#: Positions of one pass over a text, few enough for the processor's caches; positions and hashes
#: share 64 bits.
SEGMENT = 1 << 15
PLACE = np.uint64((1 << 24) - 1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
#: Bytes of fragments in one suffix array, few enough for the processor's caches.
ARRAY_BYTES = 1 << 16
#: From so many shards on, an anchor's strings go out by their contexts, and one by one.
WIDENED, SPREAD = 256, 1 << 14
#: Bytes beside the anchor in a context: one side of every string has as many.
BESIDE = (SPAN - 1) // 2


def _words(data: np.ndarray, count: int) -> np.ndarray:
    """Eight bytes from each of the first ``count`` positions; ``data`` is padded behind."""
    return np.ndarray((count,), "<u8", data, 0, (1,))


@dataclass
class Runs:
    """Strings that follow each other and share an anchor: where they start, how many, its hash.

    ``anchor`` is where it is.
    """

    start: np.ndarray
    count: np.ndarray
    key: np.ndarray
    anchor: np.ndarray

    def take(self, at: np.ndarray) -> Runs:
        return Runs(self.start[at], self.count[at], self.key[at], self.anchor[at])


def _sliding_least(x: np.ndarray) -> np.ndarray:
    """Least of each ``SPAN`` neighbours."""
    width = 1
    while 2 * width <= SPAN:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = SPAN - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchor_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Runs:
    """Runs of all strings inside the texts; ``data`` holds them one after the other, padded."""
    size = int(ends[-1]) if len(ends) else 0
    outside = np.zeros(size + 1, np.int64)
    tails = np.maximum(starts, ends - WINDOW + 1)
    np.add.at(outside, tails, 1)
    np.add.at(outside, ends, -1)
    inside = np.cumsum(outside[:-1]) == 0
    found = []
    for begin in range(0, max(size - WINDOW + 1, 0), SEGMENT):
        n = min(SEGMENT, size - WINDOW + 1 - begin)
        words = _words(data[begin:], n + WINDOW - GRAM + 8).copy()
        grams = words[:-8] * _MIX[0]
        grams ^= grams >> np.uint64(29)
        grams += words[8:] * _MIX[1]
        grams ^= grams >> np.uint64(32)
        grams *= _MIX[2]
        grams ^= grams >> np.uint64(29)
        places = np.arange(len(grams), dtype=np.uint64)
        anchor = (_sliding_least((grams & ~PLACE) | places) & PLACE).astype(np.int64)
        valid = inside[begin : begin + n]
        new = np.ones(n, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(new)
        count = np.diff(first, append=n)
        at = valid[first]
        # Anchors are small hashes; mixed once more, they are dealt evenly to buckets.
        where = anchor[first[at]]
        found.append((first[at] + begin, count[at], S.mix(grams[where]), where + begin))
    if not found:
        return Runs(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return Runs(*(np.concatenate(part) for part in zip(*found)))


def _padded(text: bytes) -> np.ndarray:
    return np.frombuffer(text + bytes(8 * WORDS + 16), np.uint8)


def _fragments(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """One row of words per fragment, zeros behind its end; ``data`` is padded behind."""
    words = _words(data, len(data) - 7)
    rows = np.empty((len(start), WORDS), np.uint64)
    for n in range(WORDS):
        over = np.clip(8 * (n + 1) - length, 0, 8).astype(np.uint64) * np.uint64(8)
        # A shift by all 64 bits is none, so it is done in two steps.
        keep = ~np.uint64(0) >> (over >> np.uint64(1)) >> (over - (over >> np.uint64(1)))
        rows[:, n] = words[np.minimum(start + 8 * n, len(words) - 1)] & keep
    return rows


def _bytes_of(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The fragments' bytes, one after the other."""
    return np.ascontiguousarray(rows).view(np.uint8)[np.arange(8 * WORDS) < length[:, None]]


def _content(rows: np.ndarray, length: np.ndarray, by: np.uint64 = _MIX[1]) -> np.ndarray:
    """A hash of each fragment; another factor ``by`` makes another hash."""
    found = length.astype(np.uint64) * _MIX[0]
    for n in range(WORDS):
        found ^= rows[:, n]
        found *= by
        found ^= found >> np.uint64(32)
    return S.mix(found)


def _keys(shard: S.Shard) -> np.ndarray:
    return np.unique(anchor_runs(_padded(shard.text), shard.starts, shard.ends).key)


class _Fragments:
    """A shard's distinct fragments whose anchor others have, in order of anchors.

    The same comes out whenever it is computed from the same shard and counts.
    """

    def __init__(self, shard: S.Shard, counts: np.ndarray) -> None:
        data = _padded(shard.text)
        runs = anchor_runs(data, shard.starts, shard.ends)
        keys, place, own = np.unique(runs.key, return_inverse=True, return_counts=True)
        shared = ((counts >= 2) | (own >= 2))[place]
        shards = counts[place]
        narrow, spread = shared & (shards < WIDENED), shared & (shards >= SPREAD)
        wide = shared & ~narrow & ~spread
        self.runs = _joined(
            runs.take(np.flatnonzero(narrow)),
            _contexts(data, runs.take(np.flatnonzero(wide))),
            _singles(data, runs.take(np.flatnonzero(spread))),
        )
        length = self.runs.count + WINDOW - 1
        rows = _fragments(data, self.runs.start, length)
        content = _content(rows, length)
        ids = shard.ids[np.searchsorted(shard.ends, self.runs.start, "right")]
        order = np.lexsort((ids, content, self.runs.key))
        key, content = self.runs.key[order], content[order]
        new = np.ones(len(order), bool)
        new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
        #: Which distinct fragment each run is, and whether its id is the shard's smallest for it.
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        head = order[new]
        self.key, self.content, self.ids, self.length = self.runs.key[head], content[new], ids[head], length[head]
        self.least = ids == self.ids[self.which] if len(order) else np.zeros(0, bool)
        self._rows = rows[head]

    def _by_content(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        name = S.mix(self.content ^ self.key)
        order = np.argsort(name)
        return name, order, S.bounds(name[order], buckets)

    def ask(self, buckets: int) -> Iterator[tuple[int, bytes]]:
        """Messages that ask for the smallest id of each fragment: 96 bits of hash, and the id."""
        name, order, at = self._by_content(buckets)
        for bucket in np.flatnonzero(np.diff(at)).tolist():
            part = order[at[bucket] : at[bucket + 1]]
            yield bucket, S.squeeze(
                np.int64(len(part)).tobytes() + name[part].tobytes()
                + self.key[part].astype(np.uint32).tobytes() + self.ids[part].tobytes()
            )

    def first(self, replies: dict[int, bytes], buckets: int) -> np.ndarray:
        """Whether the id of each fragment is the smallest of all shards."""
        found = np.zeros(len(self.key), bool)
        _, order, _ = self._by_content(buckets)
        found[order] = np.frombuffer(b"".join(S.expand(replies[b]) for b in sorted(replies)), bool)
        return found

    def messages(self, first: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
        """Texts of the fragments that are sent."""
        sent = np.flatnonzero(first)
        at = S.bounds(self.key[sent], buckets)
        for bucket in np.flatnonzero(np.diff(at)).tolist():
            part = sent[at[bucket] : at[bucket + 1]]
            texts = _bytes_of(self._rows[part], self.length[part])
            yield bucket, S.squeeze(
                np.int64(len(part)).tobytes() + self.key[part].tobytes()
                + self.ids[part].tobytes() + self.length[part].astype(np.uint8).tobytes() + texts.tobytes()
            )


def _least(sent: list[bytes]) -> list[bytes]:
    """A bucket's answer to ``ask``."""
    parts = []
    for message in sent:
        raw = S.expand(message)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        parts.append((np.frombuffer(raw, np.uint64, n, 8), np.frombuffer(raw, np.uint32, n, 8 + 8 * n), np.frombuffer(raw, np.int64, n, 8 + 12 * n)))
    name, more, ids = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((ids, more, name))
    new = np.ones(len(order), bool)
    new[1:] = (name[order][1:] != name[order][:-1]) | (more[order][1:] != more[order][:-1])
    first = np.empty(len(order), bool)
    first[order] = ids[order] == ids[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return [S.squeeze(part.tobytes()) for part in np.split(first, np.cumsum([len(p[0]) for p in parts])[:-1])]


def _joined(*parts: Runs) -> Runs:
    return Runs(*(np.concatenate(x) for x in zip(*((r.start, r.count, r.key, r.anchor) for r in parts))))


def _contexts(data: np.ndarray, runs: Runs) -> Runs:
    """Runs cut in two, where strings no longer hold ``BESIDE`` bytes in front of their anchor.

    The key of each part is a hash of the anchor with the bytes beside it that all its strings hold.
    """
    cut = np.clip(runs.anchor - BESIDE, runs.start, runs.start + runs.count)
    start, anchor = np.concatenate([runs.start, cut]), np.concatenate([runs.anchor, runs.anchor])
    count = np.concatenate([cut - runs.start, runs.start + runs.count - cut])
    before = np.arange(len(start)) < len(runs.start)
    at = np.flatnonzero(count)
    start, anchor, count, before = start[at], anchor[at], count[at], before[at]
    context, keys = anchor - BESIDE * before, [np.zeros(0, np.uint64)]
    for begin in range(0, len(start), 1 << 16):
        part = context[begin : begin + (1 << 16)]
        length = np.full(len(part), BESIDE + GRAM)
        keys.append(_content(_fragments(data, part, length), length, _MIX[2]))
    return Runs(start, count, S.mix(np.concatenate(keys) + before.astype(np.uint64)), anchor)


def _singles(data: np.ndarray, runs: Runs) -> Runs:
    """Each string a run of its own, its key a hash of the string, another than its content's."""
    start = np.repeat(runs.start, runs.count)
    start += np.arange(len(start)) - np.repeat(np.cumsum(runs.count) - runs.count, runs.count)
    count = np.ones(len(start), np.int64)
    keys = [np.zeros(0, np.uint64)]
    for begin in range(0, len(start), 1 << 16):
        part = start[begin : begin + (1 << 16)]
        length = np.full(len(part), WINDOW)
        keys.append(_content(_fragments(data, part, length), length, _MIX[2]))
    return Runs(start, count, np.concatenate(keys), np.repeat(runs.anchor, runs.count))


# Suffix arrays -------------------------------------------------------------------------------


class Suffixes:
    """Suffix array of several texts and the common prefixes of neighbours.

    A suffix ends with its text. Equal suffixes go by position.
    """

    def __init__(self, texts: np.ndarray, length: np.ndarray) -> None:
        """``texts``: the bytes one after the other."""
        self.size = len(texts)
        self.data = np.concatenate([texts, np.zeros(LONGEST + 16, np.uint8)])
        ends = np.cumsum(length)
        self.which = np.repeat(np.arange(len(length)), length)
        self.left = np.repeat(ends, length) - np.arange(self.size)
        self.order = self._sorted(int(length.max(initial=0)))
        self.common = self._prefixes()

    def _sorted(self, longest: int) -> np.ndarray:
        n = self.size
        shift = (8 * np.maximum(8 - self.left, 0)).astype(np.uint64)
        first = _words(self.data, n).byteswap()
        first = first >> shift << shift  # a shift is 56 at most, as a suffix has a byte at least
        order = np.argsort(first)
        rank = np.empty(n, np.int64)
        ordered = first[order]
        new = np.ones(n, bool)
        new[1:] = ordered[1:] != ordered[:-1]
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        # A suffix that ended and one that goes on with zero bytes look alike at first.
        tied, depth = self._tied(new), 0
        while len(tied):
            at = order[tied]
            left = self.left[at]
            if depth == 0:  # so that they part by length, before ranks are used any further on
                then = np.minimum(left, 8)
            elif depth < longest:
                then = np.where(left > depth, rank[np.minimum(at + depth, n - 1)] + 1, 0)
            else:
                then = at
            again = np.argsort((rank[at] << 32) | then)
            at, then = at[again], then[again]
            old = rank[at]
            order[tied] = at
            starts = np.ones(len(at), bool)
            starts[1:] = (old[1:] != old[:-1]) | (then[1:] != then[:-1])
            # Groups lie in one piece each, so a group's first place is its rank.
            rank[at] = np.maximum.accumulate(np.where(starts, tied, 0))
            if depth >= longest:
                break
            follows = np.ones(len(at) + 1, bool)
            follows[:-1] = starts
            tied = tied[~(follows[:-1] & follows[1:])]
            depth = 2 * depth or 8
        return order

    @staticmethod
    def _tied(new: np.ndarray) -> np.ndarray:
        follows = np.append(new, True)
        return np.flatnonzero(~(follows[:-1] & follows[1:]))

    def _prefixes(self) -> np.ndarray:
        """Bytes that each suffix shares with the one before it in order.

        Where a suffix and the one before it follow the same byte, their common prefix is one byte
        shorter than that of the suffixes one byte earlier. All others are compared.
        """
        n = self.size
        if not n:
            return np.zeros(0, np.int64)
        before = np.empty(n, np.int64)
        before[self.order[0]] = -1
        before[self.order[1:]] = self.order[:-1]
        here = np.arange(1, n)
        there = before[1:]
        inner = np.zeros(n, bool)
        inner[1:] = (
            (there > 0) & (self.which[here] == self.which[here - 1])
            & (self.which[there] == self.which[there - 1]) & (self.data[here - 1] == self.data[there - 1])
        )
        prefix = np.zeros(n, np.int64)
        at = np.flatnonzero(~inner & (before >= 0))
        prefix[at] = self._compare(at, before[at])
        last = np.maximum.accumulate(np.where(inner, 0, np.arange(n)))
        prefix = prefix[last] - (np.arange(n) - last)
        return prefix[self.order]

    def _compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        shared = np.zeros(len(a), np.int64)
        words = _words(self.data, self.size + LONGEST)
        most = np.minimum(self.left[a], self.left[b])
        going = np.arange(len(a))
        while len(going):
            x, y = a[going] + shared[going], b[going] + shared[going]
            other = words[x] ^ words[y]
            low = other & (~other + np.uint64(1))  # the lowest bit that differs
            bytes_same = np.where(other == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)).astype(np.int64) // 8)
            shared[going] += bytes_same
            going = going[(bytes_same == 8) & (shared[going] < most[going])]
        return np.minimum(shared, most)


def _classes(suffixes: Suffixes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal strings: class of each place in order, a position of it, its least id."""
    new = suffixes.common < WINDOW
    new[:1] = True
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[suffixes.which[suffixes.order]], heads) if len(heads) else ids[:0]
    return np.cumsum(new) - 1, suffixes.order[heads], least


def _as_numbers(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Strings as rows of numbers that sort as the strings do."""
    rows = np.zeros((len(at), 8 * -(-WINDOW // 8)), np.uint8)
    rows[:, :WINDOW] = data[at[:, None] + np.arange(WINDOW)]
    return rows.view(">u8").astype(np.uint64)


def _search(sorted_rows: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Binary search: for each row the first place in ``sorted_rows`` that is not before it."""
    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(sorted_rows))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        a, b = sorted_rows[middle], rows[open_]
        differs = a != b
        first = differs.argmax(1)
        place = np.arange(len(open_))
        before = differs.any(1) & (a[place, first] < b[place, first])
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]
    return low


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted strings with ids from several arrays as one: each string once, with its least id."""
    rows, least = parts[0]
    for other, ids in parts[1:]:
        at = _search(rows, other)
        same = at < len(rows)
        same[same] = (rows[at[same]] == other[same]).all(1)
        np.minimum.at(least, at[same], ids[same])
        at, new = at[~same], np.flatnonzero(~same)
        rows, least = np.insert(rows, at, other[new], 0), np.insert(least, at, ids[new])
    return rows, least


def repeated(texts: np.ndarray, length: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One number per fragment: bit n says that a smaller id has the string at place n too."""
    ends = np.cumsum(length)
    masks = np.zeros(len(length), np.uint64)
    arrays = []
    begin = 0
    while begin < len(length):
        offset = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, offset + 2 * ARRAY_BYTES)))
        part = slice(begin, min(end, len(length)))
        suffixes = Suffixes(texts[offset : ends[part.stop - 1]], length[part])
        arrays.append((part, suffixes, *_classes(suffixes, ids[part])))
        begin = part.stop
    if len(arrays) > 1:
        found = []
        for _, suffixes, _, at, least in arrays:
            whole = suffixes.left[at] >= WINDOW
            found.append((_as_numbers(suffixes.data, at[whole]), least[whole]))
        rows, least = _merged([(r, n.copy()) for r, n in found])
        for (numbers, _), (_, suffixes, _, at, own) in zip(found, arrays):
            own[suffixes.left[at] >= WINDOW] = least[_search(rows, numbers)]
    for part, suffixes, place, _, least in arrays:
        gone = np.zeros(suffixes.size, bool)
        gone[suffixes.order] = least[place] < ids[part][suffixes.which[suffixes.order]]
        gone &= suffixes.left >= WINDOW
        own = length[part]
        heads = np.cumsum(own) - own
        bit = (np.arange(suffixes.size) - np.repeat(heads, own)).astype(np.uint64)
        bits = np.where(gone, np.uint64(1) << np.minimum(bit, np.uint64(63)), np.uint64(0))
        masks[part] = np.bitwise_or.reduceat(bits, heads)
    return masks


def _answer(sent: list[bytes]) -> list[bytes]:
    """A bucket's work: the bits of every fragment that it was sent."""
    parts = []
    for message in sent:
        raw = S.expand(message)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        parts.append((
            np.frombuffer(raw, np.uint64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n),
            np.frombuffer(raw, np.uint8, n, 8 + 16 * n), np.frombuffer(raw, np.uint8, offset=8 + 17 * n),
        ))
    key, ids, length, texts = (np.concatenate(x) for x in zip(*parts))
    length = length.astype(np.int64)
    ends = np.cumsum(length)
    padded = np.concatenate([texts, np.zeros(8 * WORDS + 8, np.uint8)])
    content = _content(_fragments(padded, ends - length, length), length)
    order = np.lexsort((ids, content, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (content[order][1:] != content[order][:-1])
    head = order[new]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    # A fragment that is alone with its anchor has no string in common with others.
    found = np.zeros(len(head), np.uint64)
    group = key[head]
    alike = np.zeros(len(head) + 1, bool)
    alike[1:-1] = group[1:] == group[:-1]
    several = np.flatnonzero(alike[1:] | alike[:-1])
    for part in _pieces(group[several], length[head[several]]):
        at = head[several[part]]
        own = length[at]
        places = np.repeat(ends[at] - own - (np.cumsum(own) - own), own) + np.arange(own.sum())
        found[several[part]] = repeated(texts[places], own, ids[at])
    every = (np.uint64(1) << (length - WINDOW + 1).astype(np.uint64)) - np.uint64(1)
    masks = np.where(ids > ids[head][which], every, found[which])
    cuts = np.cumsum([len(p[0]) for p in parts])[:-1]
    return [S.squeeze(part.tobytes()) for part in np.split(masks, cuts)]


def _pieces(groups: np.ndarray, length: np.ndarray) -> Iterator[slice]:
    """Fragments that are compared with each other: whole groups, about one array's worth."""
    edges = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, len(groups))
    ends = np.cumsum(length)
    first, begin = 0, 0
    for edge in edges.tolist() if len(groups) else []:
        if edge == len(groups) or ends[edge - 1] - begin >= ARRAY_BYTES:
            yield slice(first, edge)
            first, begin = edge, ends[edge - 1]


# Cutting texts -------------------------------------------------------------------------------


def _removed(fragments: _Fragments, first: np.ndarray, masks: np.ndarray, size: int) -> np.ndarray:
    """Which bytes of the shard's texts go; ``masks`` are those of the fragments that were sent."""
    runs = fragments.runs
    own = np.zeros(len(first), np.uint64)
    own[first] = masks
    every = (np.uint64(1) << runs.count.astype(np.uint64)) - np.uint64(1)
    mask = np.where(fragments.least & first[fragments.which], own[fragments.which], every) if len(first) else every
    run = np.repeat(np.arange(len(runs.count)), runs.count)
    place = np.arange(len(run)) - np.repeat(np.cumsum(runs.count) - runs.count, runs.count)
    gone = (mask[run] >> place.astype(np.uint64)) & np.uint64(1) == 1
    start = runs.start[run[gone]] + place[gone]
    edges = np.bincount(start, minlength=size + 1) - np.bincount(start + WINDOW, minlength=size + 1)
    return np.cumsum(edges)[:-1] > 0


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Only characters all of whose bytes go."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(heads):
        return gone
    each = np.minimum.reduceat(gone, heads)
    return np.repeat(each, np.diff(heads, append=len(data)))


CUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def cut(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None, whole_characters: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``, then the columns named in ``carry``.

    Each byte goes that is covered by a string of 50 bytes which also starts in a document with a
    smaller id; ``kept`` is the rest. Strings are judged on the input and never cross documents.
    ``whole_characters`` keeps a character of which only some bytes would go, so that ``kept``
    stays UTF-8.

    A null or empty text has no bytes. A null id counts as larger than all others. Rows that share
    an id are one document for the comparison and cut row by row. Copies, ties and other columns
    change nothing.
    """
    carry = carry or []
    shards = S.pack(docs, key, text, carry)
    buckets = S.buckets_for(shards)
    counts = S.stored(S.common(shards, _keys, buckets), "anchors")
    kinds = [f"_{n} {docs.schema[c].dataType.simpleString()}" for n, c in enumerate(carry)]


    def ask(row: dict, replies: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        shard = S.Shard.read(row)
        if replies:
            found = list(_Fragments(shard, S.counts_of(replies)).ask(buckets))
            yield S._message(shard.number, [b for b, _ in found], [d for _, d in found])

    def send(row: dict, replies: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        shard, (own, least) = S.Shard.read(row), S.apart(replies, 2)
        if least:
            fragments = _Fragments(shard, S.counts_of(own))
            found = list(fragments.messages(fragments.first(least, buckets), buckets))
            yield S._message(shard.number, [b for b, _ in found], [d for _, d in found])

    least = S.stored(S.answers(S.with_answers(shards, counts, ask, S.MESSAGE), _least), "least")
    known = S.together(counts, least)
    masks = S.answers(S.with_answers(shards, known, send, S.MESSAGE), _answer)

    def finish(row: dict, replies: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        shard, (own, least, masks) = S.Shard.read(row), S.apart(replies, 3)
        data = np.frombuffer(shard.text, np.uint8)
        gone = np.zeros(len(data), bool)
        if least:
            fragments = _Fragments(shard, S.counts_of(own))
            bits = np.frombuffer(b"".join(S.expand(masks[b]) for b in sorted(masks)), np.uint64)
            gone = _removed(fragments, fragments.first(least, buckets), bits, len(data))
        if whole_characters:
            gone = _whole_characters(data, gone)
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[shard.ends] - total[shard.starts]
        spans, kept = [], []
        for start, end, n in zip(shard.starts.tolist(), shard.ends.tolist(), removed.tolist()):
            own = gone[start:end]
            spans.append(int(np.count_nonzero(own[1:] & ~own[:-1])) + int(own[0]) if n else 0)
            kept.append(data[start:end][~own].tobytes() if n else shard.text[start:end])
        columns = [
            pa.array(shard.ids, pa.int64(), mask=shard.nulls), pa.array(shard.ends - shard.starts),
            pa.array(removed), pa.array(spans, pa.int64()), pa.array(kept, pa.binary()),
        ]
        others = shard.other_columns().columns if carry else []
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *(f"_{n}" for n in range(len(carry)))]
        yield pa.RecordBatch.from_arrays([*columns, *others], names)

    found = S.with_answers(shards, S.together(counts, least, masks), finish, ", ".join([CUT, *kinds]))
    return found.withColumnsRenamed({f"_{n}": c for n, c in enumerate(carry)})
