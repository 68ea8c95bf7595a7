"""Bring a published star up to date by reading the source files that matter, and no others.

Each version lists the source files it was built from, and which orders each of them holds (its
*lineage*). A refresh compares that list with the files there are now. Orders that a new, changed or
vanished file holds or held are computed again, from the files that hold any of them, and the years
they are or were in are written again; other years keep their files. Dimensions are rebuilt where a
file of theirs changed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions import clean
from starloom.operators.merge import namespace_ids
from starloom.plans import etl, star_schema
from starloom.plans.snapshots import Counts, Snapshot, Snapshots
from starloom.plans.star_schema import Sources
from starloom.plans.stored import new_folder
from starloom.sources import files
from starloom.sources.layout import BUILD, FACT_PARTITION, LINEAGE, SOURCE_FILES

EXTRACT, DATABASE = "extract", "database"
_ORDER_TABLES = (S.ORDERS, S.ORDER_DETAILS)
_FILE = ["side", "table_name", "path", "url", "length", "modified"]
# A build rewrites no file it has listed, so url and build name one state of a file.
_STATE = ["side", "table_name", "url", BUILD]
_LINEAGE = f"side string, table_name string, url string, OrderID bigint, year int, {BUILD} string"

#: The source tables each dimension is built from.
_DIMENSION_SOURCES = {
    "dim_customer": (S.CUSTOMERS,),
    "dim_product": (S.PRODUCTS, S.CATEGORIES),
    "dim_employee": (S.EMPLOYEES,),
    "dim_shipper": (S.SHIPPERS,),
    "dim_categories": (S.CATEGORIES,),
}


@dataclass(frozen=True)
class SourceFiles:
    """Where the files of both sources lie: a folder, or a file, by table name.

    Files are not changed while a build reads them.
    """

    extract: Mapping[str, str]
    database: Mapping[str, str]
    extract_format: str = "csv"
    database_format: str = "parquet"

    def places(self) -> Iterator[tuple[str, str, str]]:
        """Side, table and path."""
        for side, paths in ((EXTRACT, self.extract), (DATABASE, self.database)):
            for table, path in paths.items():
                yield side, table, path

    def read(self, spark: SparkSession, side: str, table: str, only: Sequence[str] | None = None) -> DataFrame | None:
        paths, fmt = (self.extract, self.extract_format) if side == EXTRACT else (self.database, self.database_format)
        return files.read_extract(spark, paths[table], fmt, only=only) if table in paths else None

    def tables(self, spark: SparkSession) -> tuple[Sources, Sources]:
        return (
            {table: self.read(spark, EXTRACT, table) for table in self.extract},
            {table: self.read(spark, DATABASE, table) for table in self.database},
        )

    def listing(self, spark: SparkSession) -> DataFrame:
        found = []
        for side, table, path in self.places():
            listed = files.list_files(spark, path)
            if listed is not None:
                found.append(listed.select(F.lit(side).alias("side"), F.lit(table).alias("table_name"), *_FILE[2:]))
        if not found:
            raise FileNotFoundError("none of the sources is there")
        return reduce(DataFrame.unionByName, found)


@dataclass(frozen=True)
class _Refresh:
    snapshots: Snapshots
    sources: SourceFiles
    database_first: bool
    id_offset: int
    keep: tuple[str, ...]
    build: str

    @property
    def spark(self) -> SparkSession:
        return self.snapshots.spark

    @property
    def state(self) -> str:
        return f"refresh id_offset={self.id_offset}"

    def path(self, table: str, build: str) -> str:
        return f"{self.snapshots.root}/{table}/{BUILD}={build}"

    # What there is, and what has changed

    def write_list(self, base: Snapshot | None) -> DataFrame:
        """The files there are, each with the build that wrote its lineage."""
        now = self.sources.listing(self.spark)
        if base is None:
            listed = now.withColumn(BUILD, F.lit(self.build))
        else:
            listed = now.join(self.listed(base.sources), _FILE, "left")
            listed = listed.withColumn(BUILD, F.coalesce(BUILD, F.lit(self.build)))
        # The column would clash with the folder's name.
        listed.withColumnRenamed(BUILD, "traced").write.parquet(self.path(SOURCE_FILES, self.build))
        return self.listed(self.build)

    def listed(self, build: str) -> DataFrame:
        return self.spark.read.parquet(self.path(SOURCE_FILES, build)).withColumnRenamed("traced", BUILD)

    def write_lineage(self, new: DataFrame) -> bool:
        """Which orders each new file holds, and the years of Orders; False without such files."""
        parts = []
        for (side, table), paths in _paths(new).items():
            contract = next((t for t in _ORDER_TABLES if t.name == table), None)
            if contract is None:
                continue
            rows = self.sources.read(self.spark, side, table, paths).withColumn("url", F.input_file_name())
            if side == EXTRACT:
                rows = namespace_ids(rows, "OrderID", self.id_offset)
            rows = clean.conform(rows, contract, self.database_first, ["url"])
            year = F.lit(None).cast("int")
            if contract is S.ORDERS:
                year = F.year(clean.or_default_date(F.col("OrderDate")))
            parts.append(rows.select(F.lit(side).alias("side"), F.lit(table).alias("table_name"), "url", "OrderID", year.alias("year")))
        if parts:
            held = reduce(DataFrame.unionByName, parts).distinct()
            held.write.parquet(self.path(LINEAGE, self.build))
        return bool(parts)

    def lineage(self, builds: Sequence[str]) -> DataFrame:
        if not builds:
            return self.spark.createDataFrame([], _LINEAGE)
        reader = self.spark.read.schema(_LINEAGE).option("basePath", f"{self.snapshots.root}/{LINEAGE}")
        return reader.parquet(*[self.path(LINEAGE, build) for build in builds])

    # Building

    def whole(self) -> Snapshot:
        self.write_lineage(self.write_list(None))
        counts = Counts()

        def watch(table: S.SourceTable, df: DataFrame) -> DataFrame:
            return counts.watch(table.name, df, etl.MISSING.get(table.name))

        star = self._builder()(*self.sources.tables(self.spark), self.id_offset, self.keep, watch)
        return self.snapshots.publish(star, counts, self.state, self.keep, self.build, (self.build,))

    def _builder(self) -> Callable[..., star_schema.Star]:
        return star_schema.build_star_database_first if self.database_first else star_schema.build_star

    def changed(self, base: Snapshot) -> Snapshot:
        live, old = self.write_list(base), self.listed(base.sources)
        new, gone = live.where(F.col(BUILD) == self.build), old.join(live, _STATE, "left_anti")
        touched = {tuple(r) for r in new.unionByName(gone).select("side", "table_name").distinct().collect()}
        if not touched:
            self.snapshots.delete(self.path(SOURCE_FILES, self.build))
            return base
        changed = {table for _, table in touched}
        traced = self.write_lineage(new)
        builds = (*base.lineage, self.build) if traced else base.lineage
        fact, years = None, []
        if changed & {t.name for t in _ORDER_TABLES}:
            fact, years = self._fact(base, live, old, gone, builds)
        forget = set(changed).union(*(etl.MISSING.get(table, ()) for table in changed))
        used = {r[0] for r in live.where(F.col("table_name").isin(*(t.name for t in _ORDER_TABLES))).select(BUILD).distinct().collect()}
        lineage = tuple(build for build in builds if build in used)
        return self.snapshots.amend(base, self._dimensions(base, changed), fact, years, forget, self.build, lineage)

    def _dimensions(self, base: Snapshot, changed: set[str]) -> dict[str, DataFrame]:
        wanted = [
            name
            for name, tables in _DIMENSION_SOURCES.items()
            if name in base.builds and changed & {t.name for t in tables}
        ]
        if not wanted:
            return {}
        star = self._builder()(*self.sources.tables(self.spark), self.id_offset, self.keep)
        return {name: getattr(star, name) for name in wanted}

    def _fact(
        self, base: Snapshot, live: DataFrame, old: DataFrame, gone: DataFrame, builds: Sequence[str]
    ) -> tuple[DataFrame, list[int]]:
        """All facts of the years that change, and those years."""
        lineage = self.lineage(builds)
        of_gone = lineage.join(gone.select(*_STATE), _STATE, "left_semi")
        keys = of_gone.unionByName(lineage.where(F.col(BUILD) == self.build)).select(F.col("OrderID").alias("_order"))
        affected = self._stored(keys.distinct())
        states = live.withColumn("live", F.lit(True)).unionByName(gone.withColumn("live", F.lit(False)))
        # Where affected orders are or were: few rows, used for the files and for the years.
        places = _semi(lineage, "OrderID", affected).join(states.select(*_STATE, "path", "live"), _STATE)
        places = self._stored(places.select("side", "table_name", "path", "live", "year").distinct())
        years = [r[0] for r in places.where("year is not null").select("year").distinct().collect()]
        holding = _paths(places.where("live").select("side", "table_name", "path").distinct())
        some = _paths(live.groupBy("side", "table_name").agg(F.min("path").alias("path")))
        orders, details = (self._affected(t, holding, some, affected) for t in _ORDER_TABLES)
        again = self._stored(star_schema.fact_sales(orders, details, not self.database_first, self.keep))
        before = self.snapshots.star(base).fact_sales.where(F.col(FACT_PARTITION).isin(*years)).drop(FACT_PARTITION)
        same = before.join(affected, before["OrderKey"].eqNullSafe(affected["_order"]), "left_anti")
        return same.unionByName(again), years

    def _affected(
        self, table: S.SourceTable, holding: dict[tuple[str, str], list[str]], some: dict[tuple[str, str], list[str]], affected: DataFrame
    ) -> DataFrame:
        """The merged rows of affected orders, from the files that hold any.

        A side without such a file takes part with some file, for its columns.
        """
        found: dict[str, Sources] = {EXTRACT: {}, DATABASE: {}}
        for side, name in some:
            if name == table.name:
                paths = holding.get((side, name), some[side, name])
                found[side] = {name: self.sources.read(self.spark, side, name, paths)}
        orders = table is S.ORDERS
        merged = star_schema.merge_table(
            table,
            found[EXTRACT],
            found[DATABASE],
            dedupe=self.database_first,
            id_offset=self.id_offset,
            strict_dates=self.database_first and orders,
            keep=self.keep if orders else (),
        )
        return _semi(merged, "OrderID", affected)

    def _stored(self, df: DataFrame) -> DataFrame:
        path = new_folder(self.spark, "refresh")
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def _semi(df: DataFrame, column: str, affected: DataFrame) -> DataFrame:
    """Rows of affected orders; a missing number counts as one."""
    return df.join(affected, df[column].eqNullSafe(affected["_order"]), "left_semi")


def _paths(found: DataFrame) -> dict[tuple[str, str], list[str]]:
    """Paths by side and table: Spark's readers take them from the driver, one text per file."""
    paths: dict[tuple[str, str], list[str]] = {}
    for row in found.select("side", "table_name", "path").collect():
        paths.setdefault((row.side, row.table_name), []).append(row.path)
    return paths


def refresh(
    snapshots: Snapshots,
    sources: SourceFiles,
    database_first: bool = False,
    id_offset: int = S.DEFAULT_ID_OFFSET,
    keep: Sequence[str] = (),
) -> Snapshot:
    """The latest version, brought up to date with the files of ``sources``; itself if none changed.

    The first time, or for another variant, offset or ``keep`` than the latest version's, all is
    built. Otherwise the result equals a full build. Counts of source rows are kept for tables
    whose files did not change, and left out for the others.
    """
    base = snapshots.latest()
    job = _Refresh(snapshots, sources, database_first, id_offset, tuple(keep), uuid.uuid4().hex)
    same = base is not None and base.sources and base.state == job.state
    if same and (base.database_first, base.keep) == (database_first, job.keep):
        return job.changed(base)
    return job.whole()
