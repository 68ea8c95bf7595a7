"""Read source tables from a SQL database over JDBC."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class ParallelRead:
    """Range split of a JDBC read, so that many tasks fetch one table.

    The bounds only place the cuts; rows outside them are read too.
    """

    column: str
    lower: int
    upper: int
    partitions: int


def jdbc_options(
    url: str, table: str, split: ParallelRead | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    """Reader options for a table; the name is bracket-quoted, as it may hold spaces."""
    options = {
        "url": url,
        "dbtable": "[" + table.replace("]", "]]") + "]",
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split: ParallelRead | None = None,
    optional: bool = False,
    **options: str,
) -> DataFrame | None:
    """A database table; with ``optional``, None where the database says it has no such table.

    A missing driver, a refused login or a broken connection fails in any case.
    """
    reader = spark.read.format("jdbc").options(**jdbc_options(url, table, split)).options(**options)
    try:
        return reader.load()
    except Exception as e:
        if optional and is_absent_table(str(e)):
            return None
        raise


# How databases say that a table isn't there.
_ABSENT = (
    r"invalid object name",
    r"(table|relation|object)[^\n]{0,200}(not found|does not exist|doesn't exist)",
    r"no such table",
    r"ORA-00942",
    r"SQLCODE=-204",
)


def is_absent_table(message: str) -> bool:
    """Whether an error says that the table is not there; any other error must not pass for that."""
    return re.search("|".join(_ABSENT), message, re.IGNORECASE) is not None
