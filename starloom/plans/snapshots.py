"""Versions of a star: built aside, published as a whole, read by version, removed when old.

Every build writes files of its own (``table/build=<id>``, the fact by year as well). A commit, one
small text written last, says which builds a version consists of, and what was counted while they
were written. Readers go by the commits, so a build that is under way or has failed is not seen,
and a reader that holds a version keeps it, whatever is published later.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.plans import reports
from starloom.plans.star_schema import Star, calendar_of_fact, day_calendar
from starloom.sources import files
from starloom.sources.layout import BUILD, FACT_PARTITION, LINEAGE, SOURCE_FILES


@dataclass
class Counts:
    """Counts taken while a plan runs for another purpose: no scan is made for them.

    Rows are observed where they pass. Of a plan that runs several times the first run counts.
    """

    _open: dict[str, Observation] = field(default_factory=dict)
    _done: dict[str, int] = field(default_factory=dict)

    def watch(self, name: str, df: DataFrame, nulls: Mapping[str, str] | None = None) -> DataFrame:
        """``df``, its rows counted as ``name``, and nulls of columns under names of their own."""
        marks: list[Column] = [F.count(F.lit(1)).alias(name)]
        marks += [F.count_if(F.col(column).isNull()).alias(metric) for metric, column in (nulls or {}).items()]
        self._open[name] = Observation()
        return df.observe(self._open[name], *marks)

    def results(self) -> dict[str, int]:
        """All counts; every watched frame must have been used by then."""
        for observation in self._open.values():
            self._done |= observation.get
        self._open.clear()
        return dict(self._done)


@dataclass(frozen=True)
class Snapshot:
    """What a commit says. ``builds`` names the build of each table, of the fact the one of each year.

    ``sources`` and ``lineage`` are the builds of the list of source files and of what each file
    holds, where ``refresh`` wrote the version.
    """

    version: int
    builds: dict[str, str]
    years: dict[int, str]
    counts: dict[str, int]
    state: str
    database_first: bool
    keep: tuple[str, ...]
    sources: str = ""
    lineage: tuple[str, ...] = ()

    def paths(self, root: str) -> set[str]:
        fact = {f"{root}/fact_sales/{FACT_PARTITION}={year}/{BUILD}={build}" for year, build in self.years.items()}
        files = {f"{root}/{SOURCE_FILES}/{BUILD}={self.sources}"} if self.sources else set()
        lineage = {f"{root}/{LINEAGE}/{BUILD}={build}" for build in self.lineage}
        return fact | files | lineage | {f"{root}/{table}/{BUILD}={build}" for table, build in self.builds.items()}


class Snapshots:
    """The versions of a star below ``root``, a folder that all executors reach.

    Publishers take turns: one that finds another version published since it began fails, and
    leaves what there is untouched.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # Reading

    def all(self) -> list[Snapshot]:
        """The published versions, oldest first."""
        notes = self.spark.read.option("recursiveFileLookup", True)
        try:
            rows = notes.text(f"{self.root}/commits").collect()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return []
            raise
        found = []
        for row in rows:
            said = json.loads(row.value)
            years = {int(year): build for year, build in said.pop("years").items()}
            lists = {name: tuple(said.get(name, ())) for name in ("keep", "lineage")}
            found.append(Snapshot(**said | {"years": years} | lists))
        return sorted(found, key=lambda s: s.version)

    def latest(self) -> Snapshot | None:
        return next(reversed(self.all()), None)

    def get(self, version: int | None = None) -> Snapshot:
        """A version, the latest one by default."""
        for snapshot in reversed(self.all()):
            if version in (None, snapshot.version):
                return snapshot
        raise LookupError(f"no version {version or ''} of a star below {self.root}")

    def read(self, version: int | None = None) -> Star:
        return self.star(self.get(version))

    def star(self, snapshot: Snapshot) -> Star:
        """The tables of a snapshot; what is published later does not change them."""
        schemas = S.STAR_TABLES_DATABASE_FIRST if snapshot.database_first else S.STAR_TABLES
        schemas = schemas | {"dim_day": schemas["dim_time"], "known": files.KNOWN}
        tables = {
            name: self.spark.read.schema(schemas[name]).parquet(f"{self.root}/{name}/{BUILD}={build}")
            for name, build in snapshot.builds.items()
        }
        return Star(**tables, fact_sales=self._fact(snapshot, schemas["fact_sales"]))

    def _fact(self, snapshot: Snapshot, schema: T.StructType) -> DataFrame:
        kept = [T.StructField(c, T.StringType()) for c in snapshot.keep]
        schema = T.StructType([*schema, *kept, T.StructField(FACT_PARTITION, T.IntegerType())])
        if not snapshot.years:
            return self.spark.createDataFrame([], schema)
        folder = f"{self.root}/fact_sales"
        paths = [f"{folder}/{FACT_PARTITION}={year}/{BUILD}={build}" for year, build in sorted(snapshot.years.items())]
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths).drop(BUILD)

    def tables(self, snapshot: Snapshot) -> dict[str, DataFrame | None]:
        """For checks: the star tables of a snapshot, None for one that it lacks."""
        star = self.star(snapshot)
        found = {name: getattr(star, name) for name in S.STAR_TABLES}
        return found | {"fact_sales": star.fact_sales.drop(FACT_PARTITION)}

    # Publishing

    def publish(
        self,
        star: Star,
        counts: Counts | None = None,
        state: str = "",
        keep: tuple[str, ...] = (),
        sources: str = "",
        lineage: tuple[str, ...] = (),
    ) -> Snapshot:
        """Write all tables of ``star`` and make them the latest version.

        ``counts`` are those that the star's plans take along; the rows of each table are added.
        ``state`` says what the star was built from, ``keep`` which further columns the fact has.
        """
        base = self.latest()
        counts = counts or Counts()
        build = uuid.uuid4().hex
        first = "year_month" in star.dim_time.columns
        years = self._write_fact(star.fact_sales, build, counts)
        tables = {name: df for name, df in star.tables().items() if name != "fact_sales"}
        builds = dict.fromkeys((*tables, "dim_day", "known"), build)
        number = (base.version if base else 0) + 1
        draft = Snapshot(number, builds, dict.fromkeys(years, build), {}, state, first, keep, sources, lineage)
        if star.calendar_from_fact:
            tables["dim_time"] = calendar_of_fact(self._fact(draft, S.FACT_SALES), first)
        self._write_dimensions(tables, draft, counts)
        return self._commit(draft, base, counts.results())

    def amend(
        self,
        base: Snapshot,
        tables: Mapping[str, DataFrame],
        fact: DataFrame | None = None,
        years: Collection[int] = (),
        forget: Collection[str] = (),
        sources: str = "",
        lineage: tuple[str, ...] = (),
    ) -> Snapshot:
        """Make ``base`` with some dimensions and some years of the fact replaced the latest version.

        ``fact`` is all that the years hold from now on. The other years' files, and the other
        tables', are those of ``base``. ``forget`` names counts that no longer hold.
        """
        if base != self.latest():
            raise RuntimeError(f"version {base.version} is not the latest one")
        counts, build, tables = Counts(), uuid.uuid4().hex, dict(tables)
        kept = {name: n for name, n in base.counts.items() if name not in forget}
        draft = replace(base, version=base.version + 1, sources=sources, lineage=lineage)
        if fact is not None:
            # Parquet footers say how many rows the replaced years had.
            before = self.star(base).fact_sales.where(F.col(FACT_PARTITION).isin(*years)).count()
            written = self._write_fact(fact, build, counts)
            others = {year: b for year, b in base.years.items() if year not in years}
            draft = replace(draft, years=others | dict.fromkeys(written, build))
            replaced = self._fact(replace(draft, years=dict.fromkeys(written, build)), S.FACT_SALES)
            calendar = calendar_of_fact(replaced, base.database_first)
            unchanged = self.star(base).dim_time.where(~F.col("year").isin(*years))
            whole = unchanged.unionByName(calendar)
            tables["dim_time"] = whole.orderBy("date") if base.database_first else whole
        new = [*tables, "known", *(["dim_day"] if "dim_time" in tables else [])]
        draft = replace(draft, builds=base.builds | dict.fromkeys(new, build))
        self._write_dimensions(tables, draft, counts)
        done = counts.results()
        if fact is not None and "fact_sales" in kept:
            done["fact_sales"] += kept["fact_sales"] - before
        return self._commit(draft, base, kept | done)

    def _write_fact(self, fact: DataFrame, build: str, counts: Counts) -> list[int]:
        """Write facts by year; returns the years.

        Each task writes what it has of a year: to gather years first would shuffle the whole fact.
        """
        dated = fact.withColumns({FACT_PARTITION: F.year("OrderDate"), BUILD: F.lit(build)})
        dated = counts.watch("fact_sales", dated)
        folder = f"{self.root}/fact_sales"
        dated.write.mode("append").partitionBy(FACT_PARTITION, BUILD).parquet(folder)
        listed = files.if_present(lambda: self.spark.read.option("basePath", folder).parquet(f"{folder}/*/{BUILD}={build}"))
        return [] if listed is None else [r[0] for r in listed.select(FACT_PARTITION).distinct().collect()]

    def _write_dimensions(self, tables: Mapping[str, DataFrame], draft: Snapshot, counts: Counts) -> None:
        """Write tables that lie beside the fact, side by side, then what is derived from them."""

        def write(name: str, df: DataFrame) -> None:
            df.write.parquet(f"{self.root}/{name}/{BUILD}={draft.builds[name]}")

        with ThreadPoolExecutor(max(1, len(tables))) as pool:
            for done in [pool.submit(write, name, counts.watch(name, df)) for name, df in tables.items()]:
                done.result()
        if "dim_time" in tables:
            calendar = self.spark.read.parquet(f"{self.root}/dim_time/{BUILD}={draft.builds['dim_time']}")
            write("dim_day", day_calendar(calendar))
        there = {name: build for name, build in draft.builds.items() if name != "known"}
        write("known", reports.known_values(self.star(replace(draft, builds=there))))

    def _commit(self, draft: Snapshot, base: Snapshot | None, counts: dict[str, int]) -> Snapshot:
        now = self.latest()
        if now != base:
            raise RuntimeError(f"version {now.version if now else 0} was published while this one was built")
        done = replace(draft, counts=counts)
        note = self.spark.createDataFrame([(json.dumps(vars(done)),)], "value string").coalesce(1)
        note.write.mode("error").text(f"{self.root}/commits/v{done.version:012d}")
        return done

    # Removing

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the last ``keep`` versions, with the files that no other version has.

        Readers of a removed version fail. Returns the removed versions.
        """
        if keep < 1:
            raise ValueError("the latest version stays")
        snapshots = self.all()
        old, kept = snapshots[:-keep], snapshots[-keep:]
        used = set().union(*(s.paths(self.root) for s in kept))
        for snapshot in old:
            self.delete(f"{self.root}/commits/v{snapshot.version:012d}")
        for path in set().union(*(s.paths(self.root) for s in old)) - used:
            self.delete(path)
        return [s.version for s in old]

    def delete(self, path: str) -> None:
        spark = self.spark
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
