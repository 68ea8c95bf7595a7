import datetime as dt
import shutil
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_star import rows, sources

from starloom import schemas as S
from starloom.plans.refresh import SourceFiles, refresh
from starloom.plans.snapshots import Snapshots
from starloom.plans.star_schema import build_star, build_star_database_first


class Place:
    """Both sources as folders of files, one added at a time."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, Path(root)
        extract, sql = sources(spark)
        for table, df in extract.items():
            self.add("extract", table, df.select([F.col(c).cast("string").alias(c) for c in df.columns]))
        for table, df in sql.items():
            self.add("database", table, df)
        self.files = SourceFiles(
            {t: f"{root}/extract/{t}" for t in extract}, {t: f"{root}/database/{t}" for t in sql}
        )

    def add(self, side, table, df):
        """One more file; returns its path."""
        fmt = "csv" if side == "extract" else "parquet"
        aside, name = self.root / "aside" / uuid.uuid4().hex, uuid.uuid4().hex
        df.coalesce(1).write.format(fmt).option("header", True).save(str(aside))
        target = self.root / side / table / f"{name}.{fmt}"
        target.parent.mkdir(parents=True, exist_ok=True)
        shutil.copy(next(aside.glob("part-*")), target)
        return target

    def orders(self, *rows):
        schema = "OrderID long, CustomerID string, EmployeeID long, OrderDate timestamp_ntz, ShipVia long, Freight double"
        return self.add("database", "Orders", self.spark.createDataFrame(list(rows), schema))

    def lines(self, *rows):
        schema = "OrderID long, ProductID long, UnitPrice double, Quantity double, Discount double"
        return self.add("database", "Order Details", self.spark.createDataFrame(list(rows), schema))

    def check(self, snapshots, database_first=False, names=("fact_sales", "dim_time")):
        """A refresh gives what a full build does; ``names`` are the tables compared."""
        done = refresh(snapshots, self.files, database_first)
        build = build_star_database_first if database_first else build_star
        built, stored = build(*self.files.tables(self.spark)), snapshots.star(done)
        for name in names:
            columns = sorted(getattr(built, name).columns)
            assert rows(getattr(stored, name), *columns) == rows(getattr(built, name), *columns)
        days = snapshots.star(done).dim_time.select(F.to_date("date")).distinct().count()
        assert snapshots.star(done).dim_day.count() == days
        assert done.counts["fact_sales"] == snapshots.star(done).fact_sales.count()
        return done


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, str(tmp_path / "sources with blanks"))


@pytest.fixture
def snapshots(spark, tmp_path):
    return Snapshots(spark, str(tmp_path / "star"))


def test_files_added_changed_and_gone(place, snapshots):
    refresh(snapshots, place.files)
    new = place.orders((50, "A", 1, dt.datetime(2001, 1, 2), 1, 3.0), (51, "B", 1, dt.datetime(2003, 1, 2), 1, 4.0))
    second = refresh(snapshots, place.files)
    assert set(second.years) >= {2001, 2003}
    # A line of an order that another file holds, and lines of orders that no file has.
    lines = place.lines((50, 1, 2.0, 2.0, 0.0), (77, 1, 2.0, 2.0, 0.0), (1, 9, 1.0, 1.0, 0.0))
    third = place.check(snapshots)
    assert third.years[2003] == second.years[2003] and third.years[2001] != second.years[2001]
    # An order moves to another year, as its file is written again.
    place.orders((50, "A", 1, dt.datetime(2002, 1, 2), 1, 3.0)).replace(new)
    lines.unlink()
    fourth = place.check(snapshots)
    assert {2001, 2003}.isdisjoint(fourth.years) and 2002 in fourth.years


def test_database_first(place, snapshots):
    refresh(snapshots, place.files, database_first=True)
    place.orders((1, "A", 1, dt.datetime(2001, 1, 2), 1, 3.0))
    place.lines((1, 1, 2.0, 2.0, 0.0), (77, 1, 2.0, 2.0, 0.0))
    place.check(snapshots, database_first=True)


def test_a_dimension_alone_and_nothing(spark, place, snapshots):
    first = refresh(snapshots, place.files)
    place.add("database", "Shippers", spark.createDataFrame([(8, "New", "1")], "ShipperID long, CompanyName string, Phone string"))
    second = place.check(snapshots, names=S.STAR_TABLES)
    assert second.years == first.years
    other = {name for name in first.builds if first.builds[name] != second.builds[name]}
    assert other == {"dim_shipper", "known"}
    assert "Shippers" not in second.counts and second.counts["Orders"] == first.counts["Orders"]
    assert refresh(snapshots, place.files) == second and len(snapshots.all()) == 2
    assert len(list(Path(snapshots.root, "source_files").glob("build=*"))) == 2


def test_orders_without_a_number_and_extract_numbers(spark, place, snapshots):
    refresh(snapshots, place.files)
    gone = place.orders((None, "A", 1, dt.datetime(2001, 1, 2), 1, 3.0), (None, "B", 1, None, 1, 3.0))
    columns = "OrderID string, CustomerID string, OrderDate string, ShipVia string, Freight string"
    place.add("extract", "Orders", spark.createDataFrame([("60", "A", "2005-05-05", "1", "2")], columns))
    place.check(snapshots)
    gone.unlink()
    done = place.check(snapshots)
    assert 2001 not in done.years and 2005 in done.years


def test_all_files_of_a_side_gone(place, snapshots):
    refresh(snapshots, place.files)
    for file in Path(place.files.extract["Orders"]).iterdir():
        file.unlink()
    place.orders((52, "A", 1, dt.datetime(2001, 1, 2), 1, 3.0))
    place.files.extract.pop("Orders")
    place.check(snapshots)


def test_other_parameters_build_all(place, snapshots):
    first = refresh(snapshots, place.files)
    second = refresh(snapshots, place.files, database_first=True)
    assert second.database_first and set(second.builds.values()).isdisjoint(first.builds.values())


def test_expired_versions_and_files_read(place, snapshots, monkeypatch):
    """What later versions need stays; of the orders' files those with affected orders are read."""
    for year in (2001, 2002):
        place.orders((year, "A", 1, dt.datetime(year, 1, 2), 1, 3.0))
    refresh(snapshots, place.files)
    place.orders((2003, "A", 1, dt.datetime(2003, 1, 2), 1, 3.0))
    refresh(snapshots, place.files)
    assert snapshots.expire(keep=1) == [1]
    place.lines((2002, 1, 2.0, 2.0, 0.0))
    read, seen = SourceFiles.read, []

    def noted(self, spark, side, table, only=None):
        if only is not None and table == S.ORDERS.name and side == "database":
            seen.extend(only)
        return read(self, spark, side, table, only)

    monkeypatch.setattr(SourceFiles, "read", noted)
    done = place.check(snapshots)
    assert len(seen) == 1 and len(done.lineage) == 3
