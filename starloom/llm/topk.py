"""Exact top-k by inner product: every query row against every candidate row.

Candidates lie in blocks; a block keeps, for each component ("term"), the postings of the rows
where it is not zero. A batch of queries takes the terms one at a time and adds weight times
posting into a dense array of scores, one row per query. The k best of a block are found by
partition selection and merged over the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of a block, queries of a group, and queries scored at once.
BLOCK, GROUP, BATCH = 8192, 2048, 64
#: Components may be so large; with up to 32,768 of them scores fit into 64 bits.
MOST = 1 << 23


def quantised(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null unless all components are finite.

    One beyond ``MOST`` fails the query, as scores would not fit into 64 bits.
    """
    column = F.col(vector)
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    message = F.lit(f"a component beyond {MOST / scale:g}")

    def floored(x: Column) -> Column:
        scaled = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(scaled) > MOST, F.raise_error(message).cast("bigint")).otherwise(F.floor(scaled))

    whole = F.transform(column, floored)
    return F.when(fine, whole)


def _matrix(rows: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows as one matrix; a shorter row ends in zeros."""
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    lengths = pa.compute.list_value_length(rows).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple]:
    """For each query its ``k`` best rows with another id: ``(query, positions, scores)``."""
    order = np.argsort(ids, kind="stable")  # so that of equal scores the smaller id comes first
    rows, ids = rows[order], ids[order]
    postings = [np.flatnonzero(rows[:, term]) for term in range(rows.shape[1])]
    weights = [rows[at, term] for term, at in enumerate(postings)]
    lowest = np.iinfo(np.int64).min
    for begin in range(0, len(queries), BATCH):
        batch = queries[begin : begin + BATCH]
        scores = np.zeros((len(batch), len(ids)), np.int64)
        for term, (at, weight) in enumerate(zip(postings, weights)):
            asked = np.flatnonzero(batch[:, term])
            if len(asked) and len(at):
                part = batch[asked, term][:, None] * weight[None, :]
                if len(at) == len(ids) and len(asked) == len(batch):
                    scores += part
                else:
                    scores[np.ix_(asked, at)] += part
        own = query_ids[begin : begin + BATCH]
        low, high = np.searchsorted(ids, own), np.searchsorted(ids, own, "right")
        for i, row in enumerate(scores):
            others = len(ids) - (high[i] - low[i])
            keep = min(k, others)
            if not keep:
                continue
            row[low[i] : high[i]] = lowest
            bar = np.partition(row, len(row) - keep)[len(row) - keep]
            at = np.flatnonzero(row >= bar)
            if high[i] > low[i]:
                at = at[(at < low[i]) | (at >= high[i])]
            at = at[np.argsort(-row[at], kind="stable")][:keep]
            yield begin + i, order[at], row[at]


def top_k(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for every query row.

    Scores are inner products of the quantised vectors in 64-bit integers; equal scores go by the
    smaller id. Rows with the query's own id are no candidates for it. Rows with a null id, and
    vectors that are null or hold a null or a non-finite component, take no part; missing
    components of shorter vectors count as zero. Repeated rows are queries and candidates each:
    copies of a candidate take a rank each, copies of a query have the same result each.

    Blocks of candidates meet groups of queries in a grid, both dealt out by hash and sized by a
    count, so neither side has to fit into one task: a row goes out once per group of the other
    side, and each cell sends back at most k rows per query.
    """
    kind = vectors.schema[key].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("ids are whole numbers")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), quantised(vector, scale).alias("v"), is_query.alias("asked"))
    rows = rows.where("id is not null and v is not null")
    # Copies are one row with their number, so that a frequent row is scored once.
    asked = F.count_if(F.coalesce("asked", F.lit(False)))
    rows = rows.groupBy("id", "v").agg(F.count("*").alias("copies"), asked.alias("times")).withColumn("asked", F.col("times") > 0)
    rows = rows.withColumn("place", F.xxhash64("id", "v"))
    count = rows.agg(F.count("*"), F.count_if("asked"), F.max(F.size("v"))).first()
    blocks, groups, width = -(-count[0] // BLOCK) or 1, -(-count[1] // GROUP) or 1, max(count[2] or 0, 1)
    block = F.pmod("place", F.lit(blocks)).cast("int")
    group = F.pmod(F.shiftright("place", 20), F.lit(groups)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select("id", "v", "copies", block.alias("block"), every(groups).alias("group"))
    queries = rows.where("asked").select("id", "v", "place", "times", group.alias("group"), every(blocks).alias("block"))

    def cell(asked: pa.Table, table: pa.Table) -> pa.Table:
        found: dict[str, list] = {name: [] for name in ("query_id", "place", "times", "vec_id", "copies", "score")}
        if asked.num_rows and table.num_rows:
            query_ids, ids = (t.column("id").to_numpy() for t in (asked, table))
            places, times, copies = (t.column(c).to_numpy() for t, c in ((asked, "place"), (asked, "times"), (table, "copies")))
            for q, at, scores in best(_matrix(asked.column("v"), width), query_ids, _matrix(table.column("v"), width), ids, k):
                found["query_id"].append(np.full(len(at), query_ids[q]))
                found["place"].append(np.full(len(at), places[q]))
                found["times"].append(np.full(len(at), times[q]))
                found["vec_id"].append(ids[at])
                found["copies"].append(np.minimum(copies[at], k))
                found["score"].append(scores)
        return pa.table({n: pa.array(np.concatenate(c) if c else [], pa.int64()) for n, c in found.items()})

    cells = queries.groupBy("block", "group").cogroup(candidates.groupBy("block", "group"))
    found = cells.applyInArrow(cell, "query_id bigint, place bigint, times bigint, vec_id bigint, copies bigint, score bigint")
    found = found.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    order = Window.partitionBy("query_id", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    ranked = ranked.withColumn("time", F.explode(F.expr("sequence(1L, times)")))
    return ranked.select("query_id", "rank", "vec_id", "score")
