"""Documents packed into shards, and what shards have in common.

A shard is a row with the texts of many documents, compressed. Working on shards lets numpy take
megabytes at a time, and makes one message per shard and bucket out of what would otherwise be a
row per word or byte.

``common`` answers, for every key of every shard, in how many shards the key occurs. Shards send
their distinct keys to buckets by key range, five bytes a key; a bucket counts and sends the counts
back, one byte a key, in the order in which the keys came. A key that every document has is sent
once per shard, so no bucket grows with the number of documents that share a key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import give_back, stored

#: Text of a shard; a longer document is a shard of its own. Documents of a shard, at most.
SHARD_BYTES, SHARD_DOCS = 2 << 20, 1 << 16
#: Text per bucket of keys.
BUCKET_BYTES = 8 << 20
#: Counts up to here are exact; larger ones go in steps of an eighth of a power of two.
EXACT = 128
#: Stands for a null key, after all others.
NULL_ID = np.iinfo(np.int64).max

SCHEMA = "shard bigint, ids binary, nulls binary, lengths binary, text binary, rest binary, n_bytes bigint"

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit integers that spreads all bits (splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


@dataclass
class Shard:
    number: int
    ids: np.ndarray
    nulls: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: bytes
    rest: bytes

    @staticmethod
    def read(row: dict) -> Shard:
        lengths = np.frombuffer(row["lengths"], "<i8")
        ends = np.cumsum(lengths)
        return Shard(
            row["shard"], np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["nulls"], "?"),
            ends - lengths, ends, expand(row["text"]), row["rest"],
        )

    def texts(self) -> Iterator[bytes]:
        for start, end in zip(self.starts.tolist(), self.ends.tolist()):
            yield self.text[start:end]

    def other_columns(self) -> pa.RecordBatch:
        """What ``pack`` was told to carry, row by row."""
        with pa.ipc.open_stream(expand(self.rest)) as reader:
            return reader.read_next_batch()


def _stream(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    whole = pa.Table.from_batches(batches).combine_chunks()
    with pa.ipc.new_stream(sink, whole.schema) as writer:
        writer.write_table(whole)
    return squeeze(sink.getvalue().to_pybytes())


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Shards of ``docs``, stored in the shared folder. Null texts are empty.

    ``carry`` names other columns that shards take along.
    """
    if docs.schema[key].dataType.simpleString() not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("keys of documents are whole numbers")
    others = [F.col(c).alias(f"_{n}") for n, c in enumerate(carry or [])]
    docs = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        ids: list[int | None] = []
        texts: list[bytes] = []
        others: list[pa.RecordBatch] = []
        size = 0

        def row() -> pa.RecordBatch:
            found = [NULL_ID if i is None else i for i in ids]
            columns = {
                "shard": [number],
                "ids": [np.array(found, "<i8").tobytes()],
                "nulls": [np.array([i is None for i in ids]).tobytes()],
                "lengths": [np.array([len(t) for t in texts], "<i8").tobytes()],
                "text": [squeeze(b"".join(texts))],
                "rest": [_stream(others) if others else b""],
                "n_bytes": [size],
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            rest, begin = batch.drop_columns(["doc_id", "text"]), 0
            for n, (i, t) in enumerate(zip(batch.column("doc_id"), batch.column("text"))):
                data = (t.as_py() or "").encode()
                if texts and (size + len(data) > SHARD_BYTES or len(texts) == SHARD_DOCS):
                    if carry:
                        others.append(rest.slice(begin, n - begin))
                    yield row()
                    number, ids, texts, others, size, begin = number + 1, [], [], [], 0, n
                ids.append(i.as_py())
                texts.append(data)
                size += len(data)
            if carry:
                others.append(rest.slice(begin))
        if texts:
            yield row()
        give_back()

    return stored(docs.mapInArrow(run, SCHEMA), "shards")


def buckets_for(shards: DataFrame) -> int:
    """As many buckets as give each about ``BUCKET_BYTES`` of text, and work to every task."""
    size = shards.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(tasks, -(-size // BUCKET_BYTES))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key, by its upper half; keys in order have their buckets in order."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bounds(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin and, at the end, how many keys there are."""
    return np.searchsorted(bucket_of(sorted_keys, buckets), np.arange(buckets + 1))


def _message(shard: int, bucket: list[int], data: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array([shard] * len(bucket), pa.int64()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["shard", "bucket", "data"])


MESSAGE = "shard bigint, bucket int, data binary"


def messages(shards: DataFrame, make: Callable[[dict], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``make`` gives, for a shard's row, a message for each bucket that gets one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(make(row))
                yield _message(row["shard"], [b for b, _ in found], [d for _, d in found])
        give_back()

    return shards.mapInArrow(run, MESSAGE)


def answers(sent: DataFrame, answer: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """For each bucket, ``answer`` turns the shards' messages into one reply for each of them."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("shard")
        replies = answer([d.as_py() for d in table.column("data")])
        give_back()
        return pa.table([table.column("shard"), table.column("bucket"), pa.array(replies, pa.binary())], ["shard", "bucket", "data"])

    return sent.groupBy("bucket").applyInArrow(run, MESSAGE)


def with_answers(shards: DataFrame, replies: DataFrame, work: Callable[[dict, dict[int, bytes]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on each shard's row together with the replies to it, by bucket."""

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        by_bucket = dict(zip(found.column("bucket").to_pylist(), found.column("data").to_pylist()))
        parts = [part for row in rows.to_pylist() for part in work(row, by_bucket)]
        give_back()
        return pa.Table.from_batches(parts) if parts else empty

    empty = _empty(shards, schema)
    return shards.groupBy("shard").cogroup(replies.groupBy("shard")).applyInArrow(run, schema)


def together(*replies: DataFrame) -> DataFrame:
    """Replies of several kinds as one, for ``apart`` to tell them."""
    found = None
    for n, df in enumerate(replies):
        part = df.select("shard", (F.col("bucket") * len(replies) + n).alias("bucket"), "data")
        found = part if found is None else found.unionByName(part)
    return found


def apart(replies: dict[int, bytes], kinds: int) -> list[dict[int, bytes]]:
    found: list[dict[int, bytes]] = [{} for _ in range(kinds)]
    for place, data in replies.items():
        found[place % kinds][place // kinds] = data
    return found


def _empty(shards: DataFrame, schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema)).empty_table()


# Keys in common ------------------------------------------------------------------------------


def _send_keys(keys_of: Callable[[Shard], np.ndarray], buckets: int) -> Callable:
    def make(row: dict) -> Iterator[tuple[int, bytes]]:
        keys = keys_of(Shard.read(row))
        at = bounds(keys, buckets)
        low = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        for bucket in np.flatnonzero(np.diff(at)).tolist():
            yield bucket, low[at[bucket] : at[bucket + 1]].tobytes()

    return make


def coded(counts: np.ndarray) -> np.ndarray:
    """Counts as one byte each, never too high."""
    more = EXACT + np.floor(8 * np.log2(np.maximum(counts, EXACT) / EXACT))
    return np.where(counts < EXACT, counts, np.minimum(more, 255)).astype(np.uint8)


def _decoded() -> np.ndarray:
    codes = np.arange(256)
    return np.where(codes < EXACT, codes, np.ceil(EXACT * 2.0 ** ((codes - EXACT) / 8))).astype(np.int64)


_COUNTS = _decoded()


def _count_keys(sent: list[bytes]) -> list[bytes]:
    raw = np.frombuffer(b"".join(sent), np.uint8).reshape(-1, 5)
    keys = np.zeros((len(raw), 8), np.uint8)
    keys[:, :5] = raw
    _, place, counts = np.unique(keys.view("<u8").ravel(), return_inverse=True, return_counts=True)
    counts = coded(counts)[place]
    ends = np.cumsum([len(data) // 5 for data in sent])
    return [squeeze(part.tobytes()) for part in np.split(counts, ends[:-1])]


def common(shards: DataFrame, keys_of: Callable[[Shard], np.ndarray], buckets: int) -> DataFrame:
    """Replies with the number of shards that have each key of a shard, as ``coded``.

    ``keys_of`` gives a shard's distinct keys, well-spread 64-bit hashes in ascending order. Keys
    are compared by their bucket and their lower 40 bits, so a count may, rarely, be too high; it
    is never too low. Callers only use it to leave out what can't be shared.
    """
    return answers(messages(shards, _send_keys(keys_of, buckets)), _count_keys)


def counts_of(replies: dict[int, bytes]) -> np.ndarray:
    """One shard's counts, in the order of its keys; large ones are the lower end of their step."""
    return _COUNTS[np.frombuffer(b"".join(expand(replies[b]) for b in sorted(replies)), np.uint8)]
