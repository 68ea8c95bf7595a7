"""Quality classifier: a factorisation machine over hashed words, text structure and length.

Features of a text: its words, hashed to a fixed number of columns, and a few measures of its
structure, each as one column per interval. A score adds a bias, a weight per feature and, for
every pair of features, the product of two low-rank vectors; by the sum-of-squares identity all
pairs cost one pass over the features: half of (sum of vectors)^2 - sum of (vectors^2).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.tables import give_back, text_batches

#: Columns for hashed words; the columns of the measures come behind them.
WORDS = 1 << 15
RANK = 8
#: Labelled rows that a model is fitted on, at most. They are the first by a hash of the key.
FIT_ROWS = 8_000
EPOCHS = 6
STEP = 0.05
#: Intervals per measure of structure.
BINS = 12

_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")
_DIGIT = re.compile(r"\d")
_MARK = re.compile(r"[^\w\s]")
_END = re.compile(r"[.!?]")
_TAIL = re.compile(r"[^\w\s]{2,}(?=\s|$)")
MEASURES = 9
COLUMNS = WORDS + MEASURES * BINS


class _Buckets(dict):
    """Column of a word, by hash."""

    def __missing__(self, word: str) -> int:
        bucket = zlib.crc32(word.encode()) % WORDS
        if len(word) <= 32:
            if len(self) >= 150_000:
                self.clear()
            self[word] = bucket
        return bucket


def _share(part: int, whole: int) -> int:
    """Interval of a share, finer near nothing."""
    return min(BINS - 1, int((part / whole) ** 0.5 * BINS)) if whole else 0


def _size(n: int) -> int:
    return min(BINS - 1, n.bit_length())


def features(text: str, buckets: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Columns and their values for a whole text; the words' values have a sum of squares of 1."""
    words = text.split()
    lower = text.lower().split()
    n, chars = len(words), len(text)
    columns, counts = np.unique(np.fromiter(map(buckets.__getitem__, lower), np.int64, len(lower)), return_counts=True)
    values = np.log1p(counts).astype(np.float32)
    if len(values):
        values /= np.sqrt((values**2).sum())
    lines = text.split("\n")
    letters = len(_LETTER.findall(text))
    measured = [
        _size(n),
        _size(chars // 8),
        _share(len(_UPPER.findall(text)), letters),
        _share(len(_DIGIT.findall(text)), chars),
        _share(len(_MARK.findall(text)), chars),
        _share(len(_TAIL.findall(text)), n),
        _share(len(set(lower)), n),
        _share(len(_END.findall(text)), n),
        _share(len(set(lines)), len(lines)),
    ]
    places = WORDS + np.arange(MEASURES) * BINS + np.array(measured)
    columns = np.concatenate([columns, places])
    return columns, np.concatenate([values, np.full(MEASURES, 0.5, np.float32)])


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, columns: np.ndarray, values: np.ndarray) -> float:
        parts = self.vectors[columns] * values[:, None]
        pairs = (parts.sum(0) ** 2).sum() - (parts**2).sum()
        return float(self.bias + self.weights[columns] @ values + 0.5 * pairs)

    def score(self, text: str, buckets: dict[str, int]) -> float:
        """0 to 1; higher: the label 1 is likelier."""
        raw = self.raw(*features(text, buckets))
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """Logistic loss, both classes weighted alike, AdaGrad in small batches."""
    rng = np.random.default_rng(7)
    model = Model(0.0, np.zeros(COLUMNS), rng.normal(0, 0.05, (COLUMNS, RANK)))
    if not len(rows) or labels.min() == labels.max():
        model.bias = 0.0 if not len(rows) else float(np.where(labels.max(), 4.0, -4.0))
        return model
    share = labels.mean()
    importance = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    seen_w, seen_v, seen_b = np.full(COLUMNS, 1e-6), np.full((COLUMNS, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), 64):
            at = order[begin : begin + 64]
            columns = np.concatenate([rows[i][0] for i in at])
            values = np.concatenate([rows[i][1] for i in at])
            sizes = np.array([len(rows[i][0]) for i in at])
            starts = np.cumsum(sizes) - sizes
            used, place = np.unique(columns, return_inverse=True)
            vectors = model.vectors[used][place] * values[:, None]
            sums = np.add.reduceat(vectors, starts)
            raw = model.bias + np.add.reduceat(model.weights[used][place] * values, starts)
            raw += 0.5 * ((sums**2).sum(1) - np.add.reduceat((vectors**2).sum(1), starts))
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[at]) * importance[at] / len(at)
            each = np.repeat(error, sizes) * values
            slope_w = np.bincount(place, each, len(used)) + 1e-6 * model.weights[used]
            slopes = each[:, None] * (np.repeat(sums, sizes, 0) - vectors)
            slope_v = np.stack([np.bincount(place, slopes[:, r], len(used)) for r in range(RANK)], 1)
            slope_v += 1e-5 * model.vectors[used]
            seen_w[used] += slope_w**2
            seen_v[used] += slope_v**2
            seen_b += error.sum() ** 2
            model.weights[used] -= STEP * slope_w / np.sqrt(seen_w[used])
            model.vectors[used] -= STEP * slope_v / np.sqrt(seen_v[used])
            model.bias -= STEP * error.sum() / np.sqrt(seen_b)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text") -> Model:
    """A model from at most ``rows`` labelled documents, the first by a hash of the key.

    Labels other than 0 and 1, null keys and null labels take no part; of several labels for one
    key the largest counts, and of several texts the one with the least hash. The bound holds at
    every size of the input: the driver gets the features of that many texts, and nothing else of
    the corpus.
    """
    docs = text_batches(docs, key, text)
    known = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    kept = docs.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    kept = kept.select("doc_id", "first.text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = [features(t.as_py() or "", buckets) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.string()),
                        part.column("label"),
                        pa.array([c.astype("<u2").tobytes() for c, _ in rows], pa.binary()),
                        pa.array([v.astype("<f4").tobytes() for _, v in rows], pa.binary()),
                    ],
                    ["doc_id", "label", "columns", "values"],
                )

    found = kept.mapInArrow(run, "doc_id string, label int, columns binary, values binary").toArrow()
    # The order in which rows arrive differs from run to run; the model must not.
    found = found.sort_by([("doc_id", "ascending"), ("columns", "ascending")])
    pairs = zip(found.column("columns").to_pylist(), found.column("values").to_pylist())
    data = [(np.frombuffer(c, "<u2").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64)) for c, v in pairs]
    return fit_rows(data, found.column("label").to_numpy().astype(float))


def _scores(docs: DataFrame, model: Model, schema: str, give: Callable) -> DataFrame:
    """``docs`` through ``give(batch, scores)``; the model's size is fixed (about 1.3 MB)."""
    small = Model(model.bias, model.weights.astype("f4"), model.vectors.astype("f4"))
    shared = docs.sparkSession.sparkContext.broadcast(small)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            scores = [shared.value.score(t.as_py() or "", buckets) for t in batch.column("text")]
            yield give(batch, np.array(scores))
        del buckets
        give_back()

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row; null and empty texts are scored by length."""
    docs = text_batches(docs, key, text)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def give(batch: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
        columns = [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    return _scores(docs, model, f"doc_id {kind}, score double, predicted int", give)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``text`` scores 0.5 or more.

    Null texts are scored as empty ones are.
    """

    def give(batch: pa.RecordBatch, scores: np.ndarray) -> pa.RecordBatch:
        return batch.filter(pa.array(scores >= 0.5))

    return _scores(docs, model, docs.schema, give)


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
