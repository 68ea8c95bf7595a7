"""Small frames for the operators' tests."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, n_tokens string, component_id int"


def docs(spark, rows, parts: int = 3):
    """Documents with two columns that clash with the operators' own."""
    rows = [(i, t, "x", 7) for i, t in rows]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def by_id(df, *columns):
    """Rows as tuples, sorted, nulls first."""
    rows = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
