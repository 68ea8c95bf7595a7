"""Documents that hold a benchmark item, whole and with few edits.

An item with an error budget of k edits is split into k + 1 pieces. An occurrence with at most k
edits leaves some piece unchanged, so every occurrence has an exact piece hit (pigeonhole). Pieces
of all items are searched at once by an Aho-Corasick automaton; around each hit, Myers'
bit-parallel algorithm finds the edit distance of the whole item to the best place.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import text_batches

#: Edits that an item may have, per hundred characters of it.
PERCENT = 8
#: Characters of items that one pass over the documents searches for. More items make more passes.
BLOCK_CHARS = 2_000_000

_SPACE = re.compile(r"\s+")


def normalised(text: str) -> str:
    """Lower case, and one blank for any white space."""
    return _SPACE.sub(" ", text.lower()).strip()


def budget(item: str, percent: int) -> int:
    return len(item) * percent // 100


def pieces(item: str, count: int) -> list[tuple[int, str]]:
    """``count`` pieces of nearly the same length, with their places."""
    cuts = [len(item) * n // count for n in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Myers:
    """Bits per character of a pattern."""

    def __init__(self, pattern: str) -> None:
        self.size = len(pattern)
        self.bits: dict[str, int] = defaultdict(int)
        for n, char in enumerate(pattern):
            self.bits[char] |= 1 << n
        self.bits.default_factory = None

    def best(self, text: str) -> tuple[int, int]:
        """Least edit distance of the pattern to any part of ``text``, and where that part ends."""
        every, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = every, 0, self.size
        least, end = score, 0
        bits = self.bits.get
        for n, char in enumerate(text, 1):
            same = bits(char, 0)
            across = (((same & up) + up) ^ up) | same | down
            more = down | ~(across | up)
            less = up & across
            if more & top:
                score += 1
            elif less & top:
                score -= 1
                if score < least:
                    least, end = score, n
            more <<= 1
            less <<= 1
            same |= down
            up = (less | ~(same | more)) & every
            down = more & same & every
        return least, end


class Finder:
    """Items to search for."""

    def __init__(self, items: list[tuple[int | None, str]], percent: int) -> None:
        self._items = []
        found: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            if item := normalised(text):
                errors = budget(item, percent)
                number = len(self._items)
                self._items.append((item_id, errors, Myers(item)))
                for place, piece in pieces(item, errors + 1):
                    found[piece].append((number, place))
        self._automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self._automaton.add_word(piece, (len(piece), places))
        if found:
            self._automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int]]:
        """``(item_id, distance, end)`` of every item in the text; ``end`` in normalised text."""
        if not self._items:
            return []
        text = normalised(text)
        windows: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for last, (size, places) in self._automaton.iter(text):
            for number, place in places:
                _, errors, myers = self._items[number]
                begin = max(0, last + 1 - size - place - errors)
                end = last + 1 - size - place + myers.size + errors
                own = windows[number]
                if own and begin <= own[-1][1]:  # hits come in order of their ends
                    own[-1] = (min(own[-1][0], begin), max(own[-1][1], end))
                else:
                    own.append((begin, end))
        found = []
        for number, own in windows.items():
            item_id, errors, myers = self._items[number]
            best = min(((d, begin + at) for begin, end in own for d, at in [myers.best(text[begin:end])]))
            if best[0] <= errors:
                found.append((item_id, *best))
        return found


def _finders(benchmark: DataFrame, percent: int, key: str, text: str) -> list:
    """Broadcast finders' items, in blocks of a bounded size; one pass for each."""
    spark = benchmark.sparkSession
    if benchmark.schema[key].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("ids of items are whole numbers")
    items = benchmark.select(F.col(key).cast("bigint").alias("id"), F.col(text).cast("string").alias("text"))
    items = items.where("text is not null and text <> ''").distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // BLOCK_CHARS))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    out = []
    for block in range(blocks):
        rows = dealt.where(F.col("block") == block).orderBy("id", "text").collect()
        out.append((uuid.uuid4().hex, spark.sparkContext.broadcast([(r.id, r.text) for r in rows])))
    return out


#: A worker's finder for the block that it searched last.
_FINDER: dict[str, Finder] = {}


def _finder(block: tuple, percent: int) -> Finder:
    name, items = block
    if name not in _FINDER:
        _FINDER.clear()
        _FINDER[name] = Finder(items.value, percent)
    return _FINDER[name]


def leaks(
    docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, distance, end`` for every item in every document that holds it.

    Both are normalised (lower case, white space as one blank). ``distance`` is the least number of
    inserted, deleted or replaced characters, at most ``percent`` of the item's length; ``end`` is
    where that place ends in the normalised document, the first of several. Items without text take
    no part; an item shorter than 100 / ``percent`` must occur as it is. A null or empty document
    holds nothing. A row comes out per row, repeated or not, and other columns change nothing.

    The benchmark, which is taken to be small beside the documents, goes out in blocks of at most
    about ``BLOCK_CHARS`` characters, each with a pass of its own over the documents. Documents are
    not shuffled. A worker keeps the automaton of one block.
    """
    docs = text_batches(docs, key, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = None
    for items in _finders(benchmark, percent, item_key, item_text):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            finder = _finder(items, percent)
            for batch in batches:
                rows, hits = [], []
                for n, value in enumerate(batch.column("text")):
                    for hit in finder.find(value.as_py() or ""):
                        rows.append(n)
                        hits.append(hit)
                columns = [batch.column("doc_id").take(pa.array(rows, pa.int64()))]
                columns += [pa.array([h[k] for h in hits], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "distance", "end"])

        part = docs.mapInArrow(run, f"doc_id {kind}, item_id bigint, distance bigint, end bigint")
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``text`` holds no item of ``benchmark``.

    Null and empty texts hold none.
    """
    for items in _finders(benchmark, percent, "item_id", "text"):

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            finder = _finder(items, percent)
            for batch in batches:
                yield batch.filter(pa.array([not finder.find(t.as_py() or "") for t in batch.column("text")], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
