import pytest
from pyspark.sql import functions as F
from small_star import small_star

from starloom import schemas as S
from starloom.functions import clean
from starloom.plans import listing, quality, reports
from starloom.plans.reports import Selection, select_view


@pytest.fixture(scope="module")
def many(spark):
    """A star of 4,000 facts, a third of them on one day, many of one number."""
    star = small_star(spark)
    facts = star.fact_sales.crossJoin(spark.range(500).select("id"))
    key = F.when(F.col("id") % 3 == 0, F.col("OrderKey")).otherwise(F.col("id") * 10 + F.col("OrderKey"))
    facts = facts.withColumn("OrderKey", key).drop("id").repartition(7)
    return select_view(star.__class__(**{**vars(star), "fact_sales": facts}))


def test_pages_are_the_listing_cut_up(spark, many, tmp_path, monkeypatch):
    path = str(tmp_path / "l")
    # Small ranges, so that there are several files.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listing.store(many, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = reports.detail_table(many).select("OrderKey", "date").collect()
    zones = listing.zones(spark, path).orderBy("start").collect()
    assert len(zones) > 3 and sum(z.rows for z in zones) == len(whole)
    assert all(z.first.OrderKey == whole[z.start].OrderKey and z.first.date == whole[z.start].date for z in zones)
    size = 170
    pages = [listing.page(spark, path, n, size).select("OrderKey", "date").collect() for n in range(len(whole) // size + 2)]
    assert [r for page in pages for r in page] == whole
    assert len(pages[-1]) == 0 and all(len(p) == size for p in pages[:-2])


def test_a_page_opens_the_files_that_hold_it(spark, many, tmp_path):
    path = str(tmp_path / "l")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        listing.store(many, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    zone = listing.zones(spark, path).orderBy("start").collect()[1]
    number = -(-zone.start // 10)
    assert [f.rsplit("/", 1)[1] for f in listing.page(spark, path, number, 10).inputFiles()] == [zone.file]


def test_listings_without_rows(spark, tmp_path):
    view = select_view(small_star(spark), Selection(date_range=("2030-01-01", "2030-02-01")))
    path = str(tmp_path / "l")
    listing.store(view, path)
    assert listing.page(spark, path, 0, 10).columns == reports.detail_table(view).columns
    assert listing.page(spark, path, 0, 10).isEmpty()
    with pytest.raises(ValueError):
        listing.page(spark, path, -1, 10)


def test_rejected_cells(spark, tmp_path):
    rows = [
        ("1", "A", "2.5", "1996-07-04", "1", "x"), ("draft", "A", " ", "soon", "n/a", "0x1p3"), (None, None, None, None, None, None),
        ("7.9", "B", "3", "1996-07-04 10:00:00", "2", "nan"),
    ]
    columns = ["OrderID", "CustomerID", "EmployeeID", "OrderDate", "ShipVia", "Freight"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    path = str(tmp_path / "q")
    clean.conform_with_rejects(df, S.ORDERS).write.parquet(path)
    stored = spark.read.parquet(path)
    key = lambda r: tuple(map(str, r))
    assert sorted(stored.drop(clean.REJECTS).collect(), key=key) == sorted(clean.conform(df, S.ORDERS).collect(), key=key)
    cells = quality.quarantine({("extract", "Orders"): stored})
    assert sorted(tuple(r) for r in cells.collect()) == [
        ("extract", "Orders", "EmployeeID", "2.5", "not a whole number"),
        ("extract", "Orders", "Freight", "0x1p3", "not a number"),
        ("extract", "Orders", "Freight", "x", "not a number"),
        ("extract", "Orders", "OrderDate", "soon", "not a timestamp"),
        ("extract", "Orders", "OrderID", "draft", "not a number"),
    ]
    counts = {(r.column_name, r.reason): (r.row_count, r.example) for r in quality.rejected(cells).collect()}
    assert counts["Freight", "not a number"] == (2, "0x1p3")
    typed = spark.createDataFrame([(1, True, 2.5)], "ProductID long, Discontinued boolean, CategoryID double")
    found = clean.conform_with_rejects(typed, S.PRODUCTS).select(F.explode(clean.REJECTS)).collect()
    assert [tuple(r[0]) for r in found] == [("CategoryID", "2.5", "not a whole number")]
    plain = clean.conform_with_rejects(spark.createDataFrame([("c",)], "Other string"), S.CUSTOMERS)
    assert plain.select(F.size(clean.REJECTS)).first()[0] == 0
