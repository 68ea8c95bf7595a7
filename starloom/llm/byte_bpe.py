"""Byte-level BPE: encode texts by a rank file, decode ids again.

Each match of a pre-token pattern is encoded on its own. The merges are driven by a rank queue: one
bucket per merge rank holds the positions, in linked lists of parts, whose pair has that rank, and a
bitmap of two levels finds the smallest rank in use by find-first-set. Entries are not removed when
a neighbour merges; an entry whose pair has another rank by then is skipped. A pre-token of n bytes
takes about n steps, so texts without any white space are no trouble, and many pre-tokens share one
queue, as their merges do not touch each other.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Collection, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from starloom.llm.tables import give_back, text_batches

WORD = 256
#: Bytes of parts, with their ids, that a task remembers; speed only.
REMEMBERED = 64 << 20
#: What an entry takes beside its text and ids.
ENTRY = 180
#: Bytes of texts that are encoded together, and bytes of pre-tokens in one queue.
TOGETHER, QUEUED = 1 << 21, 1 << 20
#: Bytes of pre-tokens that go side by side.
SHORT = 64
#: Ids that are decoded at a time.
DECODED = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, which are also their ids."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Merger:
    """Ids of pre-tokens, by a rank queue.

    Entries lie in buckets by rank, and a bitmap of two levels, a bit per rank in words and a bit per
    word that isn't empty, finds the smallest rank in use. A long pre-token takes one entry after the
    other. Short ones go side by side: of the smallest word that isn't empty, each pre-token takes its
    own smallest entry, for none of them can have one in a smaller word.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values(), default=0) + 1
        self._buckets: list[list] = [[] for _ in range(size)]
        self._words = [0] * (size // WORD + 1)
        self._bit = [1 << i for i in range(max(WORD, len(self._words)))]
        self._packed = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        #: Id of the joined part, by the left part's id and then the right one's, and the other way.
        nothing: dict[int, int] = {}
        self._onward = [nothing] * (size + 1)
        self._back = [nothing] * (size + 1)
        joins = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    joins.append((left, right, rank))
                    for table, at, other in ((self._onward, left, right), (self._back, right, left)):
                        if table[at] is nothing:
                            table[at] = {}
                        table[at][other] = rank
        self._pairs = Pairs(*np.array(joins, np.int64).reshape(-1, 3).T)
        #: Ids of single bytes, then that of the mark between pre-tokens, which joins nothing.
        self._mark = size
        self._single = np.array([ranks.get(bytes([c]), size) for c in range(256)] + [size], np.int32)
        #: Ranks of pairs of bytes; the last row and column are the mark's.
        self._two = np.full((257, 257), -1, np.int32)
        for token, rank in ranks.items():
            if len(token) == 2 and ranks.get(token[:1]) is not None and ranks.get(token[1:]) is not None:
                self._two[token[0], token[1]] = rank

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token."""
        out = [self._packed.get(piece) for piece in pieces]
        queues: dict[bool, list[int]] = {False: [], True: []}
        held = dict.fromkeys(queues, 0)
        for n, ids in enumerate(out):
            if ids is None:
                short = len(pieces[n]) <= SHORT
                queues[short].append(n)
                held[short] += len(pieces[n])
                if held[short] >= QUEUED:
                    self._run(pieces, queues[short], out, short)
                    queues[short], held[short] = [], 0
        for short, which in queues.items():
            self._run(pieces, which, out, short)
        return out

    def _run(self, pieces: list[bytes], which: list[int], out: list, short: bool) -> None:
        """One queue, from the bytes of some pre-tokens to their ids."""
        if not which:
            return
        lengths = np.array([len(pieces[n]) for n in which])
        stops = np.cumsum(lengths + 1)
        size = int(stops[-1]) + 1
        inside = np.ones(size, bool)
        inside[0] = inside[stops] = False
        codes = np.full(size, 256)
        codes[inside] = np.frombuffer(b"".join([pieces[n] for n in which]), np.uint8)
        part = self._single[codes]  # id of the part that begins here, -1 where none does
        pair = np.append(self._two[codes[:-1], codes[1:]], np.int32(-1))  # id of what it and the next one make
        if short:
            self._merge_beside(part, pair, np.repeat(np.arange(len(which) + 1, dtype=np.int32), np.append(lengths + 1, 1)))
            ids = part
        else:
            ids = np.array(self._merge_long(part.tolist(), pair))
        there = (ids >= 0) & (ids != self._mark)
        ends = (4 * np.cumsum(there)[stops]).tolist()
        packed = ids[there].astype("<u4").tobytes()
        begin = 0
        for n, end in zip(which, ends):
            out[n] = packed[begin:end]
            begin = end

    def _merge_beside(self, part: np.ndarray, pair: np.ndarray, own: np.ndarray) -> None:
        """A step of all pre-tokens that have an entry in the smallest word, at a time."""
        size = len(part)
        after = np.arange(1, size + 1, dtype=np.int32)
        before = np.arange(-1, size - 1, dtype=np.int32)
        buckets: list[list[np.ndarray]] = [[] for _ in self._words]
        used = 0

        def put(places: np.ndarray) -> int:
            """Entries for the pairs at ``places``; the bits of the words that they are in."""
            ranks = pair[places]
            order = np.argsort(ranks, kind="stable")
            order = order[np.searchsorted(ranks[order], 0) :]
            if not len(order):
                return 0
            places, ranks = places[order], ranks[order]
            entries = ranks.astype(np.int64) << 32 | places
            words = ranks // WORD
            cuts = np.flatnonzero(words[1:] != words[:-1]) + 1
            bits, begin = 0, 0
            for word, end in zip(words[np.append(0, cuts)].tolist(), [*cuts.tolist(), len(entries)]):
                buckets[word].append(entries[begin:end])
                bits |= self._bit[word]
                begin = end
            return bits

        used = put(np.arange(size, dtype=np.int32))
        while used:
            word = (used & -used).bit_length() - 1
            entries = buckets[word]
            entries = entries[0] if len(entries) == 1 else np.concatenate(entries)
            places = (entries & 0xFFFFFFFF).astype(np.int32)
            fresh = pair[places] == entries >> 32  # others are stale
            entries, places = entries[fresh], places[fresh]
            buckets[word] = []
            used &= ~self._bit[word]
            if not len(entries):
                continue
            # By pre-token, then rank, then place: the first of each pre-token is due.
            order = np.argsort((own[places].astype(np.int64) << 40) | ((entries >> 32) % WORD << 32) | places)
            entries, places = entries[order], places[order]
            mine = own[places]
            due = np.append(True, mine[1:] != mine[:-1])
            if not due.all():
                buckets[word].append(entries[~due])
                used |= self._bit[word]
            at, ranks = places[due], (entries[due] >> 32).astype(np.int32)
            gone = after[at]
            end = after[gone]
            left = before[at]
            after[at], before[end] = end, at
            part[at], part[gone], pair[gone] = ranks, -1, -1
            pair[at] = self._pairs.look_up(ranks, part[end])
            pair[left] = self._pairs.look_up(part[left], ranks)
            used |= put(np.concatenate([at, left]))

    def _merge_long(self, part: list[int], first: np.ndarray) -> list[int]:
        buckets, words, bit, onward, back = self._buckets, self._words, self._bit, self._onward, self._back
        size = len(part)
        pair = first.tolist()
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        used = 0
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0) :]
        ranks, heads = np.unique(first[order], return_index=True)
        places, heads = order.tolist(), heads.tolist()
        for rank, begin, end in zip(ranks.tolist(), heads, [*heads[1:], len(places)]):
            buckets[rank] = places[begin:end]
            words[rank // WORD] |= bit[rank % WORD]
            used |= bit[rank // WORD]

        while used:
            at = (used & -used).bit_length() - 1
            word = words[at]
            rank = at * WORD + (word & -word).bit_length() - 1
            words[at] = word = word & (word - 1)
            if not word:
                used &= used - 1
            bucket = buckets[rank]
            buckets[rank] = []
            bucket.sort()  # of equal ranks the smallest position comes first
            joins_right, joins_left = onward[rank].get, back[rank].get
            for n, i in enumerate(bucket):
                if pair[i] != rank:
                    continue  # stale
                gone = after[i]
                after[i] = end = after[gone]
                before[end] = i
                part[i], part[gone], pair[gone] = rank, -1, -1
                left = before[i]
                lower = False
                pair[i] = new = joins_right(part[end], -1)
                if new >= 0:
                    if not (bucket_new := buckets[new]):
                        words[new // WORD] |= bit[new % WORD]
                        used |= bit[new // WORD]
                    bucket_new.append(i)
                    lower = new < rank
                pair[left] = new = joins_left(part[left], -1)
                if new >= 0:
                    if not (bucket_new := buckets[new]):
                        words[new // WORD] |= bit[new % WORD]
                        used |= bit[new // WORD]
                    bucket_new.append(left)
                    lower = lower or new < rank
                if lower and n + 1 < len(bucket):  # that pair is due before the rest of the bucket
                    buckets[rank] = bucket[n + 1 :] + buckets[rank]
                    words[at] |= bit[rank % WORD]
                    used |= bit[at]
                    break

        return part


class Pairs:
    """What two parts make, for arrays of ids: a table with open addresses."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        self._mask = (1 << max(4, int(4 * len(made)).bit_length())) - 1
        self._keys = np.full(self._mask + 1, -1)
        self._made = np.full(self._mask + 1, -1, np.int32)
        keys, made = left.astype(np.int64) << 32 | right, made.astype(np.int32)
        at = self._first(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[at] < 0)
            spots, chosen = np.unique(at[free], return_index=True)
            put = free[chosen]
            self._keys[spots], self._made[spots] = keys[put], made[put]
            left_over = np.ones(len(keys), bool)
            left_over[put] = False
            keys, made, at = keys[left_over], made[left_over], (at[left_over] + 1) & self._mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * 0x9E3779B97F4A7C1 & 0x7FFFFFFFFFFFFFFF) >> 24) & self._mask

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined parts, -1 where two parts make nothing."""
        keys = left.astype(np.int64) << 32 | right
        at = self._first(keys)
        found = self._keys[at]
        out = np.where(found == keys, self._made[at], np.int32(-1))
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self._mask
            found = self._keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self._made[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Memory:
    """Ids of texts seen before, within a bound: two generations, of which the older one goes.

    What is found again moves to the younger generation, so that frequent texts stay.
    """

    def __init__(self, most: int) -> None:
        self._most = most // 2
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._held = 0

    def known(self, texts: Collection[str]) -> dict[str, bytes]:
        """Those of some different texts that are remembered, with their ids."""
        young, old = self._young, self._old
        found = {text: young[text] for text in texts if text in young}
        if old:
            again = {text: old[text] for text in texts if text in old and text not in found}
            self.add(again)
            found |= again
        return found

    def add(self, ids: dict[str, bytes]) -> None:
        for text, own in ids.items():
            size = ENTRY + len(text) + len(own)
            if size > 1000:
                continue
            self._held += size
            if self._held > self._most:
                self._old, self._young, self._held = self._young, {}, size
            self._young[text] = own


#: Texts in which some space is not a single one between two characters that are no white space.
_DOUBTFUL = re.compile(r"^ | \s|\s | \Z")
_AT_SPACES = re.compile(" ?[^ ]+").findall


class Encoder:
    """Ids of texts and bytes of ids, under one vocabulary.

    ``split_at_spaces`` says of the pattern that a single space between two characters that are not
    white space always begins a match, as it does in the usual patterns. The parts between such
    spaces are then looked up whole, which spares finding the matches of known parts.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, split_at_spaces: bool = False) -> None:
        tokens = [b""] * (max(ranks.values(), default=0) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._lengths = np.array([len(token) for token in tokens])
        self._begins = np.cumsum(self._lengths) - self._lengths
        self._merge = Merger(ranks).merge
        self._split = regex.compile(pattern).findall
        self._at_spaces = split_at_spaces
        self.forget()

    def forget(self) -> None:
        """Let go of what was remembered."""
        self._known = Memory(REMEMBERED)

    def _parts(self, text: str) -> list[str]:
        """Parts of a text that can be encoded on their own."""
        return self._split(text) if not self._at_spaces or _DOUBTFUL.search(text) else _AT_SPACES(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self._parts(text) for text in texts]
        distinct = dict.fromkeys(chain.from_iterable(parts))
        ids = self._known.known(distinct)
        new = [part for part in distinct if part not in ids]
        if new:
            pieces = list(map(self._split, new))
            whole = list(dict.fromkeys(chain.from_iterable(pieces)))
            merged = dict(zip(whole, self._merge([piece.encode() for piece in whole]))).__getitem__
            fresh = {part: merged(own[0]) if len(own) == 1 else b"".join(map(merged, own)) for part, own in zip(new, pieces)}
            self._known.add(fresh)
            ids |= fresh
        return [b"".join(map(ids.__getitem__, own)) for own in parts]

    def decode(self, ids: bytes) -> bytes:
        """Each id's bytes, copied from one row of all tokens' bytes."""
        out = []
        every = np.frombuffer(ids, "<u4")
        for begin in range(0, len(every), DECODED):
            tokens = every[begin : begin + DECODED]
            lengths = self._lengths[tokens]
            stops = np.cumsum(lengths)
            places = np.repeat(self._begins[tokens] - stops + lengths, lengths)
            out.append(self._bytes[places + np.arange(len(places))].tobytes())
        return b"".join(out)


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that are encoded together; a long text is alone."""
    begin = size = 0
    for n, own in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
        own = own or 0
        if n > begin and size + own > TOGETHER:
            yield batch.slice(begin, n - begin)
            begin, size = n, 0
        size += own
    if begin < batch.num_rows:
        yield batch.slice(begin)


#: A worker's encoders, by vocabulary: tables of fixed size, as what a task remembers goes with it.
_ENCODERS: dict[tuple, Encoder] = {}


def _map_texts(docs: DataFrame, vocabulary: str, pattern: str, split_at_spaces: bool, schema: str, row: Callable) -> DataFrame:
    """``row(encoder, ids)`` for every document, the vocabulary read once, on the driver."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    key = (vocabulary, pattern, split_at_spaces)
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(key)
        if encoder is None:
            encoder = _ENCODERS[key] = Encoder(ranks.value, pattern, split_at_spaces)
        try:
            for batch in batches:
                # A batch may hold many times what is encoded together: a group's rows go out before the next one's texts.
                for group in _groups(batch):
                    ids = encoder.encode([text or "" for text in group.column("text").to_pylist()])
                    columns = [pa.array(c) for c in zip(*(row(encoder, own) for own in ids))]
                    yield pa.RecordBatch.from_arrays([group.column("doc_id"), *columns], ["doc_id", *names])
                    ids = columns = None
                batch = group = None  # else they stay while the next batch is read
        finally:
            encoder.forget()
            give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, {schema}")


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", split_at_spaces: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids``: the ids of every whole text, as packed 32-bit integers.

    The vocabulary (a rank file, under 1 MB) goes to the executors as a broadcast variable, so
    they need not see the driver's files. Null and empty texts have no ids. Null keys, repeated
    keys and other columns change nothing: a row comes out for each row. Documents are encoded
    one at a time, nothing is shuffled.
    """
    return _map_texts(
        text_batches(docs, key, text), vocabulary, pattern, split_at_spaces, "n_tokens bigint, ids binary",
        lambda _, ids: (len(ids) // 4, ids),
    )


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id, text``: the bytes that packed ids stand for; null and empty ids make no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, pattern)
        for batch in batches:
            texts = [encoder.decode(ids.as_py() or b"") for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text binary")


def round_trip(
    docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
    split_at_spaces: bool = False, with_ids: bool = False,
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every whole text, perhaps with ``ids``.

    Texts are encoded and decoded in one pass, so that ids need not be written between. Odd rows
    are treated as in ``encode``.
    """

    def row(encoder: Encoder, ids: bytes) -> tuple:
        back = encoder.decode(ids)
        digests = hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest()
        return (len(ids) // 4, *digests, ids) if with_ids else (len(ids) // 4, *digests)

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return _map_texts(text_batches(docs, key, text), vocabulary, pattern, split_at_spaces, schema, row)
