"""Compare every registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import decimal
import math
import sys
import time

import duckdb

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    assert not isinstance(value, decimal.Decimal), "decimals are not part of any contract"
    return value


def _sorted_rows(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    rows = [tuple(_cell(v) for v in row) for row in zip(*columns)]
    return sorted(rows, key=repr)


def _types(table) -> list[tuple[str, str]]:
    found = {f.name: str(f.type).replace("large_", "") for f in table.schema}
    return sorted(found.items())


def compare(spark, sf_dir: str, name: str, db=None) -> str | None:
    """None where both agree in names, types and rows, else what differs."""
    db = db or connect(sf_dir)
    ours = entry.queries()[name](spark, sf_dir).toArrow()
    theirs = db.execute(entry.oracle_sql()[name]).to_arrow_table()
    if _types(ours) != _types(theirs):
        return f"schema {sorted(set(_types(ours)) ^ set(_types(theirs)))}"
    left, right = _sorted_rows(ours), _sorted_rows(theirs)
    if left == right:
        return None
    example = next(((a, b) for a, b in zip(left, right) if a != b), None)
    return f"rows {len(left)} and {len(right)}; {example}"


if __name__ == "__main__":
    from starloom.session import local_session

    sf_dir = sys.argv[1]
    spark = local_session("8")
    db = connect(sf_dir)
    names = sys.argv[2:] or list(entry.queries())
    failed = 0
    for name in names:
        start = time.time()
        if name not in entry.oracle_sql():
            result = f"no SQL, {entry.queries()[name](spark, sf_dir).count()} rows"
        else:
            try:
                result = compare(spark, sf_dir, name, db)
            except Exception as e:
                result = "error " + str(e)[:600]
            failed += result is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {result or 'ok'}", flush=True)
    print("failed:", failed)
