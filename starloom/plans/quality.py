"""Checks on the star tables and on the merged sources behind them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions import clean
from starloom.operators.join import lookup
from starloom.plans.star_schema import Star

Tables = Mapping[str, DataFrame | None]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def contract(spark: SparkSession, tables: Tables) -> DataFrame:
    """One row per required table: present, columns missing, rows, columns, verdict."""
    schema = (
        "table_name string, present boolean, missing_columns string, "
        "row_count bigint, column_count int, ok boolean"
    )
    parts = []
    for name, required in S.REQUIRED_COLUMNS.items():
        df = tables.get(name)
        if df is None:
            parts.append(spark.createDataFrame([(name, False, None, None, None, False)], schema))
            continue
        missing = [c for c in required if c not in df.columns]
        parts.append(
            df.agg(
                F.lit(name).alias("table_name"),
                F.lit(True).alias("present"),
                F.lit(",".join(missing)).alias("missing_columns"),
                F.count(F.lit(1)).alias("row_count"),
                F.lit(len(df.columns)).alias("column_count"),
                F.lit(not missing).alias("ok"),
            )
        )
    return _union(parts)


def verdict(report: DataFrame) -> DataFrame:
    """Whether every table passed."""
    return report.agg(F.bool_and("ok").alias("all_ok"))


def row_counts(tables: Tables) -> DataFrame:
    present = {name: df for name, df in tables.items() if df is not None}
    return _union(
        [
            df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
            for name, df in present.items()
        ]
    )


def listed(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """Counts that are there already, as a table."""
    return spark.createDataFrame(sorted(counts.items()), "metric string, row_count bigint")


def quarantine(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """``source, table_name, column_name, text, reason`` of every rejected cell.

    ``tables`` maps a source's and a table's name to rows with ``clean.REJECTS``.
    """
    parts = []
    for (source, table), df in tables.items():
        cells = df.where(F.size(clean.REJECTS) > 0).select(F.explode(clean.REJECTS).alias("cell"))
        parts.append(cells.select(F.lit(source).alias("source"), F.lit(table).alias("table_name"), "cell.*"))
    return _union(parts)


def rejected(cells: DataFrame) -> DataFrame:
    """Rejected cells per source, column and reason: how many, and the first text by name."""
    keys = "source", "table_name", "column_name", "reason"
    return cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), F.min("text").alias("example"))


def preview(tables: Tables, rows: int = 3, columns: int = 5) -> DataFrame:
    """First rows of each table, by its first columns, as text: a top-k, not a sample."""
    parts = []
    for name, required in S.REQUIRED_COLUMNS.items():
        df = tables.get(name)
        if df is None:
            continue
        shown = [c for c in required if c in df.columns][:columns]
        first = df.select(*shown).orderBy(*[F.col(c).asc_nulls_last() for c in shown]).limit(rows)
        pairs = [
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in shown
        ]
        parts.append(
            first.select(F.lit(name).alias("table_name"), F.explode(F.array(*pairs)).alias("p"))
            .select("table_name", "p.column_name", "p.value")
        )
    return _union(parts)


def null_counts(columns: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows without a usable value in a column, per metric.

    The frames are merged sources, conformed and not yet deduplicated, where a value that can't be
    read is null: orders without a date, products without a number, rejected whole-number keys.
    """
    return _union(
        [
            df.agg(
                F.lit(metric).alias("metric"), F.count_if(F.col(column).isNull()).alias("row_count")
            )
            for metric, (df, column) in columns.items()
        ]
    )


def order_gap(orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Distinct orders expected, fact rows present, and the difference."""
    expected = orders.agg(F.count_distinct("OrderID")).scalar()
    return fact.agg(F.count(F.lit(1)).alias("fact_rows")).select(
        expected.alias("expected_orders"),
        "fact_rows",
        (expected - F.col("fact_rows")).alias("gap"),
    )


def differences(expected: DataFrame, present: DataFrame, key: str, ranges: int = 4096) -> DataFrame:
    """``key, expected, present``: keys that two tables have a different number of times.

    Both are summed up per range of the keys' hash first: how many keys, and the sum of a hash of
    each key with its count. Only ranges whose sums differ are looked into, key by key, so that
    tables which nearly agree send little more than their partial sums. Rows without a key take no
    part.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))
        return counts.withColumn("range", F.pmod(F.xxhash64(key), F.lit(ranges)))

    def summed(counts: DataFrame, name: str) -> DataFrame:
        # Hashes are shortened so that their sum over many keys stays in range.
        mark = F.sum(F.shiftright(F.xxhash64(key, name), 24)).alias(f"{name}_sum")
        return counts.groupBy("range").agg(F.count(F.lit(1)).alias(f"{name}_keys"), mark)

    left, right = counted(expected, "expected"), counted(present, "present")
    sums = summed(left, "expected").join(summed(right, "present"), "range", "full")
    same = F.col("expected_keys").eqNullSafe(F.col("present_keys")) & F.col("expected_sum").eqNullSafe(F.col("present_sum"))
    differing = sums.where(~same).select("range")
    left, right = (lookup(df, differing, "range", "left_semi").drop("range") for df in (left, right))
    joined = left.join(right, key, "full")
    zero = F.lit(0).cast("bigint")
    joined = joined.withColumns({c: F.coalesce(c, zero) for c in ("expected", "present")})
    return joined.where(F.col("expected") != F.col("present")).select(key, "expected", "present")


def order_differences(orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Which orders the gap between orders and facts consists of: each should have one fact."""
    expected = orders.select("OrderID").distinct()
    return differences(expected, fact.select(F.col("OrderKey").alias("OrderID")), "OrderID")


_KEYS = {
    "dim_time": "TimeKey",
    "dim_customer": "CustomerKey",
    "dim_employee": "EmployeeKey",
    "dim_shipper": "ShipperKey",
}


def orphans(star: Star) -> DataFrame:
    """Per dimension: facts with a key, and those of them whose key no dimension row has."""
    parts = []
    for name, key in _KEYS.items():
        facts = star.fact_sales.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        known = getattr(star, name).select(F.col(key).alias("_known")).distinct()
        joined = facts.join(known, F.col(key) == F.col("_known"), "left")
        lost = F.when(F.col("_known").isNull(), F.col("n")).otherwise(F.lit(0))
        parts.append(
            joined.agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("facts"),
                F.coalesce(F.sum(lost), F.lit(0)).cast("bigint").alias("orphans"),
            )
        )
    return _union(parts)


def key_counts(tables: Tables) -> DataFrame:
    """Rows and distinct keys of each dimension that is there."""
    keys = _KEYS | {"dim_product": "ProductKey"}
    return _union(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_distinct(keys[name]).alias("key_count"),
            )
            for name, df in tables.items()
            if df is not None and name in keys
        ]
    )
