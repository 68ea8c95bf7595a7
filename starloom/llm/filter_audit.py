"""What each of several filters removes, in every order in which they could be applied.

A document is reduced to the set of filters that it fails, and documents to counts per such set.
Filters and orders then meet as matrices: a mask has 0 where a filter removes it and infinity where
not, an order has each filter's position (the inverse of the permutation). Their product over
(minimum, plus) is the step at which an order removes a mask. Counts scattered over these steps give
what every step removes, and what it would have removed but for earlier steps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.operators.join import lookup

#: Filters at most, as all their orders are listed.
MOST_FILTERS = 7

_NOT_CONTINUED = bytes(b for b in range(256) if b & 0xC0 != 0x80)


class Text:
    """A text as UTF-8, with what filters ask of it."""

    def __init__(self, data: bytes) -> None:
        self.data = data
        #: What ASCII white space separates.
        self.words = data.split()

    def code_points(self) -> int:
        return len(self.data) - len(self.data.translate(None, _NOT_CONTINUED))

    def count(self, characters: bytes) -> int:
        """How many characters are one of these ASCII ones."""
        return len(self.data) - len(self.data.translate(None, characters))


Test = Callable[[Text], bool]


def failures(docs: DataFrame, tests: Mapping[str, Test], part: str, key: str, text: str) -> DataFrame:
    """``doc_id, part, mask, digest``: a bit per test that the text fails, and 128 bits of its hash."""
    docs = docs.select(
        docs[key].alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
        docs[text].cast("string").alias("text"),
    )
    checks = list(tests.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in batch.column("text").cast(pa.binary()):
                found = Text(value.as_py() or b"")
                masks.append(sum(1 << bit for bit, fails in enumerate(checks) if fails(found)))
                digests.append(hashlib.blake2b(found.data, digest_size=16).digest())
            columns = [batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "mask", "digest"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, part string, mask int, digest binary")


def removal_steps(n_filters: int) -> tuple[np.ndarray, np.ndarray]:
    """``orders[o, s]``, the filter at each step, and ``steps[m, o]``, when an order removes a mask.

    Steps count from 0; ``n_filters`` stands for never.
    """
    orders = np.array(list(permutations(range(n_filters))), np.int64).reshape(-1, n_filters)
    positions = np.argsort(orders, axis=1)
    masks = np.arange(1 << n_filters)
    cost = np.where(masks[:, None] >> np.arange(n_filters) & 1, 0, n_filters)
    steps = np.full((len(masks), len(orders)), n_filters)
    for f in range(n_filters):  # the (min, +) product, a filter at a time
        np.minimum(steps, cost[:, f, None] + positions[None, :, f], out=steps)
    return orders, steps


def interactions(counts: DataFrame, names: list[str], weights: Mapping[str, str]) -> DataFrame:
    """A row for every part, order and step from ``part, mask, n`` and the columns in ``weights``.

    ``counts`` has one row per part and mask. ``weights`` maps a column to the name of the result
    that adds it up over what a step removes. A part's at most 2^filters rows come to one task.
    """
    width = len(names)
    orders, steps = removal_steps(width)
    spelled = ["".join(names[f] for f in order) for order in orders]
    given = ["n", *weights]
    fails = (np.arange(1 << width)[:, None] >> np.arange(width) & 1).astype(np.int64)
    spots = steps + np.arange(len(orders)) * (width + 1)

    def scatter(weight: np.ndarray) -> np.ndarray:
        """Weight by order and step, the last one for what stays."""
        out = np.zeros(len(orders) * (width + 1), np.int64)
        np.add.at(out, spots, weight[:, None])
        return out.reshape(len(orders), width + 1)

    def of_part(rows: list[dict]) -> list[np.ndarray]:
        weight = np.zeros((len(given), 1 << width), np.int64)
        for row in rows:
            weight[:, row["mask"]] += [row[c] for c in given]
        n = weight[0]
        removed, *lost = (scatter(w)[:, :width] for w in weight)
        kept = n.sum() - removed.cumsum(1)
        redundant = (n @ fails)[orders] - removed
        unique = n[1 << np.arange(width)][orders]
        shapley = np.bincount(orders.ravel(), removed.ravel(), width).astype(np.int64)[orders]
        return [kept, removed, redundant, unique, *lost, shapley]

    results = ["kept", "removed", "redundant", "unique_fails", *weights.values(), "shapley"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, rows in zip(batch.column("part").to_pylist(), batch.column("rows")):
                size = len(orders) * width
                columns = [
                    pa.array([part] * size, pa.string()),
                    pa.array(np.repeat(spelled, width).tolist(), pa.string()),
                    pa.array(np.tile(np.arange(1, width + 1), len(orders)), pa.int32()),
                    *(pa.array(c.ravel(), pa.int64()) for c in of_part(rows.as_py())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *results])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in results)
    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *given)).alias("rows"))
    return by_part.mapInArrow(run, schema)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    tests: Mapping[str, Test],
    duplicates: str,
    weights: Mapping[str, tuple[str, int]],
    part: str = "lang",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``part, filter_order, step``, then counts of documents for that filter in that order.

    ``tests`` maps one letter per filter to what a text fails by. ``duplicates`` is the letter of one
    more filter, which removes a text that a smaller key has, anywhere in the table. ``weights``
    maps a result's name to the label and value that it counts among what a step removes.

    ``kept`` remain after the step, ``removed`` go at it; ``redundant`` fail its filter but went
    before, ``unique_fails`` fail its filter only, ``shapley`` adds what the filter removes over all
    orders. Every part has a row for every order and step.

    Null texts are empty, null parts the empty string. Null keys come after all others and have no
    labels; of several labels for one key the largest counts. Rows that share a key and text are
    counted each, and none is a duplicate of the other. An empty table gives no rows. Other columns
    change nothing.
    """
    names = [*tests, duplicates]
    if len(names) > MOST_FILTERS or len("".join(names)) != len(set(names)):
        raise ValueError(f"filters need different letters, {MOST_FILTERS} at most: {names}")
    rows = stored(failures(docs, tests, part, key, text), "failures")
    # The smallest key of every text that more than one row has; a hot text is one row per task.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = lookup(rows, first.select("digest", "first"), "digest", right_grouped=True)
    again = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    rows = rows.withColumn("mask", F.col("mask") + F.when(again, 1 << len(tests)).otherwise(0))

    columns = {f"w{i}": (label == value).cast("int") for i, (label, value) in enumerate((F.col(c), v) for c, v in weights.values())}
    marked = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("doc_id"))
    marked = marked.agg(*(F.max(value).alias(c) for c, value in columns.items()))
    rows = lookup(rows.select("doc_id", "part", "mask"), marked, "doc_id", right_grouped=True)
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in columns]
    counts = rows.groupBy("part", "mask").agg(F.count("*").alias("n"), *sums)
    return interactions(counts, names, dict(zip(columns, weights)))
