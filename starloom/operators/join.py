"""Left lookups that stay whole and balanced when a key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", right_grouped: bool = False
) -> DataFrame:
    """Join ``right``, unique by ``key``, to ``left``.

    There is no broadcast hint: Spark broadcasts ``right`` only when its size, from file
    statistics or measured by AQE, is below ``spark.sql.autoBroadcastJoinThreshold``.

    Beyond that it is a sort-merge join, where one key (or null) may hold a third of ``left``.
    AQE splits such a partition, but only if both sides arrive straight from an exchange. Say
    ``right_grouped`` where ``right`` was just grouped by ``key``: a second equality, which
    follows from the first and so changes no result, then keeps that grouping from lending its
    partitioning to the join.
    """
    other = "_lookup_key"
    while other in {c.lower() for c in (*left.columns, *right.columns)}:
        other = f"_{other}"
    right = right.withColumnRenamed(key, other)
    same = F.col(key) == F.col(other)
    if right_grouped:
        same = same & (F.xxhash64(F.col(key)) == F.xxhash64(F.col(other)))
    return left.join(right, same, how).drop(other)

