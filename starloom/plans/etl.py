"""The whole job: read both sources, build the star, store it, check it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from starloom import schemas as S
from starloom.plans import quality
from starloom.plans.star_schema import Sources, build_star, build_star_database_first
from starloom.plans.snapshots import Counts, Snapshot, Snapshots
from starloom.plans.stored import new_folder
from starloom.sources import database, files


def load_extracts(
    spark: SparkSession, folder: str, fmt: str = "csv"
) -> dict[str, DataFrame | None]:
    """The extracts of a folder, named after their tables, blanks or underscores in the name."""
    found = {}
    for table in S.SOURCE_TABLES:
        names = dict.fromkeys([table.name, table.name.replace(" ", "_")])
        extracts = (files.read_extract(spark, f"{folder}/{n}.{fmt}", fmt) for n in names)
        found[table.name] = next((df for df in extracts if df is not None), None)
    return found


def load_database(
    spark: SparkSession,
    url: str,
    splits: Mapping[str, database.ParallelRead] | None = None,
    optional: bool = False,
    **options: str,
) -> dict[str, DataFrame | None]:
    """The tables of a database; ``splits`` cuts the large ones into parallel reads.

    Orders and Order Details must have a split, as one task would read them otherwise.

    Each is copied to the shared folder first: the build scans some of them several times, and
    all scans must see the same rows.
    """
    splits, folder = splits or {}, new_folder(spark, "database")
    if unsplit := [t.name for t in (S.ORDERS, S.ORDER_DETAILS) if t.name not in splits]:
        raise ValueError(f"say how to split the reads of {', '.join(unsplit)}")
    found = {}
    for t in S.SOURCE_TABLES:
        df = database.read_table(spark, url, t.name, splits.get(t.name), optional, **options)
        if df is not None:
            copy = f"{folder}/{t.name.replace(' ', '_')}"
            df.write.parquet(copy)
            df = spark.read.parquet(copy)
        found[t.name] = df
    return found


def run(
    spark: SparkSession,
    extract: Sources,
    sql: Sources,
    out: str,
    database_first: bool = False,
    id_offset: int = S.DEFAULT_ID_OFFSET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Build a star and publish it below ``out``; returns the contract report on the stored tables.

    Readers of ``Snapshots(spark, out)`` have the version before until this one is whole, and go
    on with it if the build fails. ``keep`` names order columns beyond the contract that the fact
    carries along.
    """
    snapshots = Snapshots(spark, out)
    published = publish(snapshots, extract, sql, database_first, id_offset, keep)
    return quality.contract(spark, snapshots.tables(published))


#: Values that the data check counts as missing: the table, the column, the count's name.
MISSING = {
    S.ORDERS.name: {"missing_order_dates": "OrderDate"},
    S.PRODUCTS.name: {"invalid_products": "ProductID"},
    S.EMPLOYEES.name: {"rejected_employee_keys": "EmployeeID"},
}


def publish(
    snapshots: Snapshots,
    extract: Sources,
    sql: Sources,
    database_first: bool = False,
    id_offset: int = S.DEFAULT_ID_OFFSET,
    keep: Sequence[str] = (),
    state: str = "",
) -> Snapshot:
    """Build a star and publish it, with the counts of source rows that the data check asks for.

    They are taken while the tables are written: rows of the merged sources by table name, rows of
    the star's tables, and values that are missing or can't be read.
    """
    counts = Counts()

    def watch(table: S.SourceTable, df: DataFrame) -> DataFrame:
        return counts.watch(table.name, df, MISSING.get(table.name))

    build = build_star_database_first if database_first else build_star
    star = build(extract, sql, id_offset, keep, watch)
    return snapshots.publish(star, counts, state, tuple(keep))
