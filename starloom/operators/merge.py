"""Bring two sources of one table together: key namespaces, union, keep-first."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import clean
from starloom.schemas import DEFAULT_ID_OFFSET

_PRIORITY = "_priority"


def namespace_ids(
    df: DataFrame, column: str = "OrderID", offset: int = DEFAULT_ID_OFFSET
) -> DataFrame:
    """Shift an identifier column by ``offset``; rows without a numeric identifier are dropped."""
    if column not in df.columns:
        raise KeyError(f"column {column} not found")
    is_text = df.schema[column].dataType.simpleString() == "string"
    shifted = clean.truncated_id(F.col(column), is_text) + F.lit(offset).cast("bigint")
    return df.withColumn(column, shifted).where(F.col(column).isNotNull())


def require_below(df: DataFrame, column: str, offset: int) -> DataFrame:
    """Fail the query on an identifier that reaches into the namespace starting at ``offset``.

    A check per row: it costs no extra pass, unlike asking for the maximum beforehand.
    """
    message = F.concat(
        F.lit(f"{column} reaches the namespace at {offset}: "), F.col(column).cast("string")
    )
    clash = F.col(column) >= F.lit(offset).cast("bigint")
    return df.withColumn(
        column, F.when(clash, F.raise_error(message).cast("bigint")).otherwise(F.col(column))
    )


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def keep_first(df: DataFrame, keys: Sequence[str], first_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the first by ``first_by``, ties broken by the remaining columns.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so each
    task sends at most one row per key, however often a key is repeated.
    """
    rest = [c for c in df.columns if c not in keys and c not in first_by]
    order = [F.col(c).asc_nulls_last() for c in (*first_by, *rest)] or [F.col(keys[0])]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def union_sources(extract: DataFrame | None, sql: DataFrame | None) -> DataFrame | None:
    """Union by column name, missing columns null; a single source stands for itself."""
    if extract is None or sql is None:
        return extract if sql is None else sql
    return extract.unionByName(sql, allowMissingColumns=True)


def merge_sources(
    extract: DataFrame | None,
    sql: DataFrame | None,
    keys: Sequence[str],
    dedupe: bool = True,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame | None:
    """Merge two sources of a table; with ``dedupe`` the extract's row wins for a shared key.

    ``watch`` gets the rows of both, before any is dropped, and returns them.
    """
    watch = watch or (lambda df: df)
    if not dedupe:
        merged = union_sources(extract, sql)
        return None if merged is None else watch(merged)
    merged = union_sources(
        None if extract is None else extract.withColumn(_PRIORITY, F.lit(0)),
        None if sql is None else sql.withColumn(_PRIORITY, F.lit(1)),
    )
    if merged is None:
        return None
    merged = drop_null_keys(watch(merged), keys)
    return keep_first(merged, keys, [_PRIORITY]).drop(_PRIORITY)
