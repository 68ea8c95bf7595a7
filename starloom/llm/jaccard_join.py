"""Documents whose sets of word n-grams have a Jaccard similarity of a threshold or more.

1. Shards of documents count in how many shards each of their n-grams occurs (``shards.common``).
   Two sets that link share one of the rarest n-grams of either: a set of n with threshold t needs
   only its n - ceil(tn) + 1 rarest ones for that (its prefix). N-grams that nobody else has link
   nothing, so most documents have no prefix left and are done.
2. Equal sets become one row. Sets that share some prefix n-gram are joined to blocks, as connected
   components; no link leaves its block.
3. Blocks are dealt into tiles: a small block is one tile. A large one is cut into bands of set
   size, so that linked sets lie in the same band or in neighbouring ones, and each band by hash
   into parts; every two parts that may hold a link make a tile.
4. A tile holds the sets as sorted arrays and as bitmaps of hashed members. The bits in which two
   bitmaps differ bound the overlap from above; what passes is intersected exactly. Sets that the
   tile has already linked in some way are not compared again, and a tile returns only the links
   that joined something.
5. Links are joined to components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm import shards as S
from starloom.llm.components import components
from starloom.llm.tables import give_back, stored
from starloom.operators.join import lookup

#: Sets of a block that one tile may hold, and of a part of a larger block. A large set counts as
#: one more per so many members.
TILE, PART, MEMBERS = 1024, 512, 1000
#: Bits of a bitmap: the power of two next to twice the largest set in the tile, at most this.
BITS = 8192

_P1, _P2 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    """Hash of a word."""

    def __missing__(self, word: bytes) -> int:
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 32:
            if len(self) >= 300_000:
                self.clear()
            self[word] = found
        return found


def grams(text: bytes, n: int, words: _Words) -> np.ndarray:
    """A text's distinct word n-grams, hashed, in order; all words as one if there are fewer.

    A-Z are lower-cased; words are what ASCII white space separates.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    size = min(n, len(each))
    count = len(each) - size + 1
    found = np.full(count, size, np.uint64)
    for k in range(size):
        found = S.mix(found * _P1 + each[k : k + count] * _P2)
    return np.unique(found)


def required(size: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Members that a set shares with any set it links to, at least."""
    return -(-size * percent // 100)


def _shard_sets(shard: S.Shard, n: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The documents' sets, the shard's distinct n-grams and how many documents have each."""
    words = _Words()
    sets = [grams(text, n, words) for text in shard.texts()]
    members = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return sets, *np.unique(members, return_counts=True)


SIGNED = "doc_id bigint, number bigint, n_shingles bigint, same binary, prefix binary, text binary"


def _sign(n: int, percent: int, carry: list[str], with_text: bool):
    def run(row: dict, replies: dict[int, bytes]) -> Iterator[pa.RecordBatch]:
        shard = S.Shard.read(row)
        sets, keys, own = _shard_sets(shard, n)
        counts = S.counts_of(replies) if replies else np.zeros(0, np.int64)
        shared = (counts >= 2) | (own >= 2)
        # A rarer n-gram comes first; the order is the same for all documents of all shards.
        level = np.floor(np.log2(np.maximum(counts, 1))).astype(np.uint64) if len(counts) else counts
        same, prefix, texts = [], [], []
        for members, text in zip(sets, shard.texts()):
            size = len(members)
            same.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest() if size else None)
            at = np.searchsorted(keys, members)
            first = np.lexsort((members, level[at]))[: size - required(size, percent) + 1] if size else []
            chosen = members[first][shared[at[first]]] if size else members
            prefix.append(chosen.tobytes() if len(chosen) else None)
            texts.append(text if with_text or len(chosen) else None)
        columns = [
            pa.array(shard.ids, pa.int64(), mask=shard.nulls),
            pa.array(np.arange(len(sets)) + shard.number * S.SHARD_DOCS, pa.int64()),
            pa.array([len(s) for s in sets], pa.int64()),
            *(pa.array(c, pa.binary()) for c in (same, prefix, texts)),
        ]
        others = shard.other_columns().columns if carry else []
        names = ["doc_id", "number", "n_shingles", "same", "prefix", "text", *(f"_{k}" for k in range(len(carry)))]
        yield pa.RecordBatch.from_arrays([*columns, *others], names)

    return run


def _explode_prefix(sets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = np.frombuffer(row["prefix"], "<i8")
                node = pa.array([row["node"]] * len(keys), pa.binary())
                yield pa.RecordBatch.from_arrays([node, pa.array(keys, pa.int64())], ["node", "gram"])

    return sets.select("node", "prefix").mapInArrow(run, "node binary, gram bigint")


def _blocks(sets: DataFrame) -> DataFrame:
    """``node, block``: sets that may link to others, and what joins them."""
    grams = _explode_prefix(sets)
    hubs = grams.groupBy("gram").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    edges = lookup(grams, hubs, "gram", "inner", right_grouped=True).where("node <> hub").select("node", "hub").distinct()
    return components(edges, "node", "hub").select("node", F.col("root").alias("block"))


def _parts_of(count: Column) -> Column:
    return F.ceil(count / PART).cast("int")


def _tiles(sets: DataFrame, blocks: DataFrame, percent: int) -> DataFrame:
    """``tile, side, node, size, text``: every set once per tile that it is in."""
    rows = lookup(sets.select("node", "size", "text"), blocks, "node", "inner", right_grouped=True)
    # Sizes of linked sets differ by the threshold at most, so their bands by one.
    band = F.col("size").cast("int")
    if percent < 100:
        band = F.floor(F.log(band.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    rows = rows.withColumns({"band": band, "place": F.xxhash64("node")})
    # How many sets each band of each block has, then how many parts it and its neighbours make.
    # A block has as many rows here as it has bands, so windows over it stay small.
    counts = rows.groupBy("block", "band").agg(F.sum(1 + F.col("size") / MEMBERS).alias("n"))
    of_block = Window.partitionBy("block")
    by_band = of_block.orderBy("band")
    total = F.sum("n").over(of_block)
    counts = counts.withColumn("parts", F.when(total <= TILE, 0).otherwise(_parts_of(F.col("n"))))
    below = F.when(F.lag("band").over(by_band) == F.col("band") - 1, F.lag("parts").over(by_band))
    above = F.when(F.lead("band").over(by_band) == F.col("band") + 1, F.lead("parts").over(by_band))
    counts = counts.select(F.struct("block", "band").alias("spot"), "parts", below.alias("below"), above.alias("above"))
    rows = lookup(rows.withColumn("spot", F.struct("block", "band")), counts, "spot", "inner", right_grouped=True)
    part = F.pmod("place", F.greatest("parts", F.lit(1))).cast("int")
    rows = rows.withColumn("part", F.when(F.col("parts") > 0, part).otherwise(F.lit(0)))

    def tile(low_band: Column, low: Column, high_band: Column, high: Column, side: Column) -> Column:
        return F.struct(
            low_band.alias("low_band"), low.alias("low"), high_band.alias("high_band"), high.alias("high"), side.alias("side")
        )

    b, p, zero = F.col("band"), F.col("part"), F.lit(0)
    upto = lambda n: F.sequence(zero, F.coalesce(n, zero))
    own = F.transform(
        F.filter(upto(F.col("parts")), lambda q: q < F.col("parts")),
        lambda q: tile(b, F.least(p, q), b, F.greatest(p, q), F.when(p <= q, 0).otherwise(1)),
    )
    below = F.transform(
        F.filter(upto(F.col("below")), lambda q: q < F.coalesce("below", zero)), lambda q: tile(b - 1, q, b, p, F.lit(1))
    )
    above = F.transform(
        F.filter(upto(F.col("above")), lambda q: q < F.coalesce("above", zero)), lambda q: tile(b, p, b + 1, q, F.lit(0))
    )
    alone = F.array(tile(zero, zero, zero, zero, zero))
    rows = rows.withColumn("at", F.explode(F.when(F.col("parts") == 0, alone).otherwise(F.concat(own, below, above))))
    name = F.struct("block", "at.low_band", "at.low", "at.high_band", "at.high")
    return rows.select(F.md5(F.to_json(name)).alias("tile"), F.col("at.side").alias("side"), "node", "size", "text")


class _Joined:
    """Which members of a tile are linked in some way so far."""

    def __init__(self, count: int) -> None:
        self.label = np.arange(count)

    def join(self, a: int, b: int) -> None:
        x, y = self.label[a], self.label[b]
        self.label[self.label == y] = x


def links(sets: list[np.ndarray], sides: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all members of the tile that links of the tile connect.

    Where ``sides`` has two values, only members of different sides are compared, as the others
    meet in other tiles.
    """
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sides = sides[order]
    sizes = np.array([len(sets[i]) for i in order])
    width = min(BITS, 1 << int(2 * sizes.max(initial=32) - 1).bit_length())
    bitmaps = np.zeros((len(order), width // 8), np.uint8)
    for row, i in enumerate(order):
        bits = np.bincount((sets[i] >> np.uint64(7)).astype(np.int64) & (width - 1), minlength=width) & 1
        bitmaps[row] = np.packbits(bits.astype(np.uint8))
    bitmaps = bitmaps.view("<u8")
    two = len(np.unique(sides)) == 2
    joined = _Joined(len(order))
    found = []
    for i in range(len(order)):
        last = int(np.searchsorted(sizes * percent, 100 * sizes[i], "right"))
        at = np.arange(i + 1, last)
        if two:
            at = at[sides[at] != sides[i]]
        at = at[joined.label[at] != joined.label[i]]
        if not len(at):
            continue
        # Members that only one of two sets has flip a bit each, so these are as many at least.
        apart = np.bitwise_count(bitmaps[at] ^ bitmaps[i]).sum(1, dtype=np.int64)
        both = sizes[at] + sizes[i]
        most = (both - apart) // 2
        for j in at[100 * most >= percent * (both - most)].tolist():
            if joined.label[j] == joined.label[i]:
                continue
            a, b = sets[order[i]], sets[order[j]]
            place = np.searchsorted(b, a)
            shared = int(np.count_nonzero(b[np.minimum(place, len(b) - 1)] == a))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                found.append((order[i], order[j]))
                joined.join(i, j)
    return found


def _linked(tiles: DataFrame, n: int, percent: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        words = _Words()
        sets = [grams(t.as_py(), n, words) for t in table.column("text")]
        pairs = links(sets, table.column("side").to_numpy(), percent)
        nodes = table.column("node")
        columns = [pa.array([nodes[p[k]].as_py() for p in pairs], pa.binary()) for k in (0, 1)]
        give_back()
        return pa.table(columns, names=["a", "b"])

    return tiles.groupBy("tile").applyInArrow(run, "a binary, b binary")


def classes(
    docs: DataFrame,
    n: int,
    percent: int,
    key: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    with_text: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, perhaps ``text``, then the columns in ``carry``.

    A document's set holds its distinct word n-grams, or all its words as one where it has fewer.
    Documents link where 100 * intersection >= ``percent`` * union; ``component_id`` is the
    smallest id that links reach, the document's own included. ``kept`` marks one document per
    component: of those with the smallest id, the first row.

    A null or empty text, or one of white space only, has an empty set and links to nothing. A null
    id counts as larger than all others. Rows that share an id are compared like others. Other
    columns change nothing.
    """
    carry = carry or []
    shards = S.pack(docs, key, text, carry)
    buckets = S.buckets_for(shards)
    counts = S.common(shards, lambda shard: _shard_sets(shard, n)[1], buckets)
    kinds = [f"_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(carry)]
    schema = ", ".join([SIGNED, *kinds])
    signed = stored(S.with_answers(shards, counts, _sign(n, percent, carry, with_text), schema), "sets")

    # From here on only sets that share some rare n-gram with another document.
    some = signed.where("prefix is not null")
    first = F.struct(F.coalesce("doc_id", F.lit(S.NULL_ID)).alias("id"), "number")
    sets = some.groupBy(F.col("same").alias("node")).agg(
        F.min(first).alias("first"),
        F.first("n_shingles").alias("size"),
        F.first("prefix").alias("prefix"),
        F.first("text").alias("text"),
    )
    sets = stored(sets, "candidates")
    tiles = _tiles(sets, stored(_blocks(sets), "blocks"), percent)
    roots = components(_linked(tiles, n, percent), "a", "b")
    rooted = lookup(sets.select("node", "first"), roots, "node", right_grouped=True)
    rooted = stored(rooted.select("node", "first", F.coalesce("root", "node").alias("root")), "roots")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    rooted = lookup(rooted.select("node", "root"), least, "root", right_grouped=True)
    rooted = rooted.select(F.col("node").alias("same"), "least")

    others = [F.col(f"_{k}") for k in range(len(carry))]
    if with_text:
        others.insert(0, F.col("text").cast("string").alias("text"))
    found = lookup(some.drop("prefix"), rooted, "same", right_grouped=True).select(
        "doc_id", "n_shingles",
        F.nullif(F.col("least.id"), F.lit(S.NULL_ID)).alias("component_id"),
        (F.col("least.number") == F.col("number")).alias("kept"), *others,
    )
    alone = signed.where("prefix is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), *others
    )
    return found.unionByName(alone).withColumnsRenamed({f"_{k}": c for k, c in enumerate(carry)})
