"""Sums, groupings and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exact_sum(col: str) -> Column:
    """Sum of a money column to the millionth, as a decimal; 0 over no rows.

    A sum of doubles depends on the order of the rows. Here whole units and millionths are
    added up as integers, which is as fast as adding doubles, unlike a cast of every value to
    decimal. Integers too large to add fail the query.
    """
    value = F.col(col)
    units = F.floor(value)
    millionths = F.rint((value - units) * 1_000_000).cast("bigint")
    total = F.sum(units).cast("decimal(20,0)") + F.sum(millionths).cast(
        "decimal(20,0)"
    ) * F.lit("0.000001").cast("decimal(6,6)")
    return F.coalesce(total, F.lit(0).cast("decimal(1,0)")).cast("decimal(30,6)")


def sum_by(df: DataFrame, key: str, measure: str, alias: str) -> DataFrame:
    """Exact sum per key; rows without a key are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(exact_sum(measure).alias(alias))


def top(df: DataFrame, measure: str, name: str, n: int = 10) -> DataFrame:
    """The ``n`` largest by ``measure`` (ties by name), smallest first for display."""
    largest = df.orderBy(F.col(measure).desc(), F.col(name)).limit(n)
    return largest.orderBy(F.col(measure).asc(), F.col(name).desc())
