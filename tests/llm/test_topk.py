import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import oracle, topk

SCHEMA = "vec_id bigint, embedding array<float>, score string, place int"


def brute(rows, k, scale=256):
    fine = []
    for vec_id, v in rows:
        if vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        fine.append((vec_id, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)))
    out = []
    for q, a in fine:
        if q % 50 == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in fine if c != q]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def _found(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, k).collect())


def test_against_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "GROUP", 4)
    rng = random.Random(4)
    # Few different values, zeros among them, so that scores tie.
    rows = [(i, [rng.choice([0.0, 0.0, 0.25, -0.5, 0.1]) for _ in range(6)]) for i in range(400)]
    assert _found(spark, rows) == brute(rows, 5)


def test_repeated_rows_as_in_the_sql(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.randint(0, 120), [rng.choice([0.0, 0.25, 1.0]) for _ in range(3)]) for _ in range(150)]
    rows += [rows[0]] * 40 + [(50, [1.0, 1.0, 1.0])] * 9 + [(7, [4.0, 4.0, 4.0])] * 3
    path = f"{tmp_path}/embeddings"
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    expected = db.execute(f"SELECT query_id, rank, vec_id, score FROM ({oracle.all_sql()['op2_exact_topk']})").fetchall()
    assert _found(spark, rows) == sorted(expected) == brute(rows, 5)


def test_long_vectors_and_large_components(spark):
    rows = [(i, [float(i)] * 3000) for i in range(3)] + [(50, [0.5] * 2000)]
    assert _found(spark, rows) == brute(rows, 5)
    with pytest.raises(Exception, match="a component beyond"):
        _found(spark, [(0, [1e30]), (1, [1.0])])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.5]), (50, [0.0, 2.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]),
        (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, []), (100, []),
    ]
    assert _found(spark, rows) == brute(rows, 5)
    assert _found(spark, rows[:1]) == []
    assert _found(spark, []) == []
