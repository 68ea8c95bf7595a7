import threading
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_star import rows, sources

from starloom import schemas as S
from starloom.plans import etl, quality
from starloom.plans.snapshots import Counts, Snapshots
from starloom.plans.star_schema import build_star, build_star_database_first
from starloom.sources import files


@pytest.fixture(scope="module")
def star(spark):
    return build_star(*sources(spark))


def content(star):
    return {name: rows(df, *sorted(c for c in df.columns if c != "order_year")) for name, df in star.tables().items()}


def test_published_tables_are_the_built_ones(spark, star, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    assert snapshots.latest() is None
    with pytest.raises(LookupError):
        snapshots.read()
    done = snapshots.publish(star)
    assert snapshots.latest() == snapshots.get(1) == done
    assert content(snapshots.read()) == content(star)
    assert sorted(done.years) == sorted({r[0].year for r in star.fact_sales.select("OrderDate").collect()})


def test_database_first_and_further_columns(spark, tmp_path):
    extract, sql = sources(spark)
    extract["Orders"] = extract["Orders"].withColumn("Note", F.lit("n"))
    snapshots = Snapshots(spark, str(tmp_path))
    done = etl.publish(snapshots, extract, sql, database_first=True, keep=["Note"])
    assert done.database_first and done.keep == ("Note",)
    assert content(snapshots.read()) == content(build_star_database_first(extract, sql, keep=["Note"]))


def test_a_reader_keeps_its_version(spark, star, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    snapshots.publish(star)
    held = snapshots.read()
    fewer = replace(star, fact_sales=star.fact_sales.where("OrderKey = 1"), calendar_from_fact=False)
    snapshots.publish(fewer)
    assert content(held) == content(star)
    assert content(snapshots.read()) == content(fewer)
    assert content(snapshots.read(1)) == content(star)


@pytest.mark.parametrize("table", ["fact_sales", "dim_shipper"])
def test_a_failed_build_is_not_seen(spark, star, tmp_path, table):
    snapshots = Snapshots(spark, str(tmp_path))
    first = snapshots.publish(star)
    bad = getattr(star, table)
    column = bad.columns[0]
    broken = bad.withColumn(column, F.when(F.rand(1) < 2, F.raise_error(F.lit("disk is full"))).cast(bad.schema[0].dataType))
    with pytest.raises(Exception, match="disk is full"):
        snapshots.publish(replace(star, **{table: broken}))
    assert snapshots.all() == [first]
    assert content(snapshots.read()) == content(star)
    assert snapshots.publish(star).version == 2


def test_a_build_halfway_is_not_seen(spark, star, tmp_path, monkeypatch):
    """A publisher that stops after writing its tables, before the commit."""
    snapshots = Snapshots(spark, str(tmp_path))
    first = snapshots.publish(star)
    monkeypatch.setattr(Snapshots, "_commit", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        snapshots.publish(replace(star, dim_shipper=star.dim_shipper.limit(0)))
    monkeypatch.undo()
    assert snapshots.all() == [first]
    assert content(snapshots.read()) == content(star)


def test_the_later_of_two_publishers_fails(spark, star, tmp_path, monkeypatch):
    one, other = Snapshots(spark, str(tmp_path)), Snapshots(spark, str(tmp_path))
    write = Snapshots._write_dimensions
    once = threading.Event()

    def interrupted(self, *args):
        if not once.is_set():
            once.set()
            other.publish(star)
        return write(self, *args)

    monkeypatch.setattr(Snapshots, "_write_dimensions", interrupted)
    with pytest.raises(RuntimeError, match="version 1 was published"):
        one.publish(replace(star, dim_shipper=star.dim_shipper.limit(0)))
    assert [s.version for s in one.all()] == [1]
    assert content(one.read()) == content(star)


def test_old_versions_expire(spark, star, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    for _ in range(3):
        snapshots.publish(star)
    assert snapshots.expire(keep=2) == [1]
    assert [s.version for s in snapshots.all()] == [2, 3]
    assert content(snapshots.read(2)) == content(star)
    gone = {p.name for p in Path(tmp_path).rglob("build=*")}
    assert gone == {f"build={s.builds['dim_time']}" for s in snapshots.all()}
    assert snapshots.expire(keep=5) == []
    with pytest.raises(ValueError):
        snapshots.expire(keep=0)


def test_counts_taken_while_writing_equal_counts_by_scan(spark, tmp_path):
    extract, sql = sources(spark, dated=False)
    snapshots = Snapshots(spark, str(tmp_path))
    counts = etl.publish(snapshots, extract, sql).counts
    assert snapshots.latest().counts == counts
    scanned = quality.row_counts(snapshots.tables(snapshots.latest())).collect()
    assert {r.table_name: r.row_count for r in scanned} == {t: counts[t] for t in S.STAR_TABLES}
    from starloom.plans.star_schema import merge_table

    for table in S.SOURCE_TABLES:
        merged = merge_table(table, extract, sql, dedupe=False)
        assert counts[table.name] == merged.count()
        for metric, column in etl.MISSING.get(table.name, {}).items():
            assert counts[metric] == merged.where(F.col(column).isNull()).count()


def test_counting_starts_no_job_of_its_own(spark):
    counts = Counts()
    seen = counts.watch("t", spark.range(7).toDF("x"), {"lost": "x"})
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    seen.write.format("noop").mode("overwrite").save()
    after = len(tracker.getJobIdsForGroup())
    assert counts.results() == {"t": 7, "lost": 0} and counts.results() == {"t": 7, "lost": 0}
    assert len(tracker.getJobIdsForGroup()) == after == before + 1


def test_a_star_without_facts(spark, star, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    snapshots.publish(replace(star, fact_sales=star.fact_sales.limit(0)))
    assert snapshots.latest().years == {}
    assert snapshots.read().fact_sales.count() == snapshots.read().dim_time.count() == 0


def test_a_year_is_written_by_the_tasks_that_have_it(spark, star, tmp_path):
    """The facts are not shuffled once more to gather their years."""
    rows = star.fact_sales.crossJoin(spark.range(50)).drop("id")
    spread = replace(star, fact_sales=rows.repartition(4))
    snapshots = Snapshots(spark, str(tmp_path))
    done = snapshots.publish(spread)
    assert len(list((tmp_path / "fact_sales").rglob("*.parquet"))) == 4 * len(done.years)
    assert content(snapshots.read())["fact_sales"] == content(spread)["fact_sales"]


def test_the_stored_calendar_comes_from_the_stored_fact(spark, star, tmp_path):
    """Where the fact holds every date, the orders are not read again for the calendar."""
    fail = F.raise_error(F.lit("read again")).cast("timestamp_ntz")
    unread = star.dim_time.withColumn("date", F.coalesce(F.when(F.col("year") < 0, F.col("date")), fail))
    files.write_star(replace(star, dim_time=unread, calendar_from_fact=True), str(tmp_path))
    back = files.read_star(spark, str(tmp_path))
    dates = sorted(r.OrderDate for r in star.fact_sales.select("OrderDate").distinct().collect())
    assert sorted(r.date for r in back.dim_time.collect()) == dates
    assert sorted(r.date for r in back.dim_day.collect()) == sorted({d.replace(hour=0, minute=0, second=0) for d in dates})
