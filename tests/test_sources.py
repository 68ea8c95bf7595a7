import shutil
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from small_star import small_star

from starloom import schemas as S
from starloom.plans import etl, quality
from starloom.plans.star_schema import merge_table
from starloom.plans.stored import StoredStars, new_folder, shared_folder
from starloom.sources import database, files


def test_csv_extract(spark, tmp_path):
    path = tmp_path / "Order_Details.csv"
    path.write_text(
        'Order ID,Ship Name,Title\n1,Zürich,"Vice President, Sales"\n2,nan,"say ""hi"""\n',
        encoding="utf-8",
    )
    df = files.read_extract(spark, str(path))
    assert df.columns == ["OrderID", "ShipName", "Title"]
    assert [tuple(r) for r in df.collect()] == [
        ("1", "Zürich", "Vice President, Sales"),
        ("2", None, 'say "hi"'),
    ]
    assert files.read_extract(spark, str(tmp_path / "nothing.csv")) is None
    found = etl.load_extracts(spark, str(tmp_path))
    assert found["Order Details"].count() == 2
    assert [n for n, t in found.items() if t is None] == [
        "Orders", "Customers", "Products", "Employees", "Shippers", "Categories",
    ]


def test_parquet_extract(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "Order ID").write.parquet(f"{tmp_path}/Orders.parquet")
    df = files.read_extract(spark, f"{tmp_path}/Orders.parquet", "parquet")
    assert df.columns == ["OrderID"] and df.count() == 3


def test_jdbc_options():
    split = database.ParallelRead("OrderID", 1, 1000, 16)
    options = database.jdbc_options("jdbc:x:y", "Order Details", split)
    assert options["dbtable"] == "[Order Details]"
    assert (options["partitionColumn"], options["numPartitions"]) == ("OrderID", "16")
    assert "partitionColumn" not in database.jdbc_options("jdbc:x:y", "Orders")


def test_missing_database(spark):
    """Without a driver nothing is known about the table, so it isn't taken for absent."""
    for optional in (False, True):
        with pytest.raises(Exception):
            database.read_table(spark, "jdbc:none:x", "Orders", optional=optional)


@pytest.mark.parametrize(
    "message, absent",
    [
        ("Invalid object name 'Orders'.", True),
        ('ERROR: relation "Orders" does not exist', True),
        ("Table 'shop.Orders' doesn't exist", True),
        ("[SQLITE_ERROR] (no such table: Orders)", True),
        ("ORA-00942: table or view does not exist", True),
        ("Login failed for user 'x'.", False),
        ("Connection refused", False),
        ("No suitable driver", False),
        ("The TCP/IP connection to the host has failed", False),
    ],
)
def test_absent_table_is_told_from_other_errors(message, absent):
    assert database.is_absent_table(message) is absent


def test_database_tables_are_read_once(spark, monkeypatch):
    asked = []

    def read(spark, url, table, split=None, optional=False, **options):
        asked.append((table, split))
        return None if table == "Shippers" else spark.range(3).selectExpr("id", "uuid() as v")

    monkeypatch.setattr(database, "read_table", read)
    split = database.ParallelRead("OrderID", 1, 9, 3)
    with pytest.raises(ValueError, match="Order Details"):
        etl.load_database(spark, "jdbc:x", {"Orders": split}, optional=True)
    splits = {"Orders": split, "Order Details": split}
    found = etl.load_database(spark, "jdbc:x", splits, optional=True)
    assert found["Shippers"] is None and asked[0] == ("Orders", split) and len(asked) == 7
    orders = found["Order Details"]
    assert sorted(orders.collect()) == sorted(orders.collect())
    assert "FileScan parquet" in orders._jdf.queryExecution().executedPlan().toString()


def test_fingerprint(spark, tmp_path):
    spark.range(5).repartition(2).write.parquet(f"{tmp_path}/a")
    paths = {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"}
    rows = {r.table_name: r for r in files.fingerprint(spark, paths).collect()}
    assert rows["a"].file_count == 2 and rows["a"].byte_count > 0
    assert tuple(rows["b"])[1:] == (None, None, None)


def test_stored_star_follows_its_sources(spark, tmp_path):
    source = f"{tmp_path}/source"
    builds = []

    def build():
        builds.append(1)
        return small_star(spark)

    spark.range(1).write.parquet(source)
    stars = StoredStars()
    first = stars.get(spark, {"s": source}, build)
    assert first.fact_sales.count() == 8
    assert stars.path(spark, {"s": source}, build) == stars.path(spark, {"s": source}, build)
    assert len(builds) == 1
    spark.range(1000).write.mode("append").parquet(source)
    stars.get(spark, {"s": source}, build)
    assert len(builds) == 2
    # As the next session would: it finds the star, unless its folder is gone.
    path = StoredStars().path(spark, {"s": source}, build)
    assert path == stars.path(spark, {"s": source}, build) and len(builds) == 2
    other = StoredStars(database_first=True)
    with pytest.raises(RuntimeError, match="no build"):
        other.path(spark, {"s": source}, failing)
    shutil.rmtree(path)
    assert StoredStars().path(spark, {"s": source}, build) != path and len(builds) == 3


def failing():
    raise RuntimeError("no build")


class Session:
    """Just enough of a session to ask for its folder."""

    def __init__(self, master, folder):
        self.conf = {"spark.sql.warehouse.dir": "/tables/"}
        if folder:
            self.conf["spark.checkpoint.dir"] = folder
        self.sparkContext = SimpleNamespace(master=master, applicationId="app")


def test_shared_folder_comes_from_the_session():
    cluster = Session("spark://host:7077", "/somewhere/shared/")
    assert shared_folder(cluster) == "/somewhere/shared"
    assert new_folder(cluster, "star").startswith("/somewhere/shared/star-")
    assert shared_folder(Session("local[8]", None)) == "/tables"


def test_contract_names_what_is_missing(spark, tmp_path):
    files.write_star(small_star(spark), str(tmp_path))
    tables = files.stored_tables(spark, str(tmp_path))
    tables["dim_shipper"] = tables["dim_shipper"].drop("Phone")
    tables["dim_product"] = None
    report = {r.table_name: r for r in quality.contract(spark, tables).collect()}
    assert list(report) == [
        "dim_time", "dim_customer", "dim_product", "dim_employee", "dim_shipper", "fact_sales",
    ]
    assert report["dim_shipper"].missing_columns == "Phone"
    assert not report["dim_shipper"].ok and not report["dim_product"].present
    assert report["fact_sales"].ok and report["fact_sales"].row_count == 8
    assert quality.verdict(quality.contract(spark, tables)).first().all_ok is False


def test_counts_gap_and_preview(spark):
    tables = small_star(spark).tables()
    counts = {r.table_name: r.row_count for r in quality.row_counts(tables).collect()}
    assert counts["dim_time"] == 6 and counts["fact_sales"] == 8
    orders = spark.createDataFrame([(i,) for i in (1, 2, 2, 3, None)], "OrderID long")
    gap = quality.order_gap(orders, tables["fact_sales"]).first()
    assert tuple(gap) == (3, 8, -5)
    preview = quality.preview(tables).where("table_name = 'dim_customer'").collect()
    assert len(preview) == 15
    assert {r.value for r in preview if r.column_name == "CustomerKey"} == {"A", "B", "C"}


def test_null_counts(spark):
    """Over both sources: what one of them lacks counts, whichever it is."""
    sheet = {
        "Orders": spark.createDataFrame([("1", "1996-07-04"), ("2", "soon"), ("x", None)], "OrderID string, OrderDate string"),
        "Products": spark.createDataFrame([("1",), ("TBD",)], "ProductID string"),
    }
    sql = {
        "Orders": spark.createDataFrame([(1, None), (2, None)], "OrderID long, OrderDate timestamp_ntz"),
        "Products": spark.createDataFrame([(1,), (None,)], "ProductID long"),
    }
    columns = {
        "missing_order_dates": (merge_table(S.ORDERS, sheet, sql, dedupe=False), "OrderDate"),
        "invalid_products": (merge_table(S.PRODUCTS, sheet, sql, dedupe=False), "ProductID"),
    }
    found = {r.metric: r.row_count for r in quality.null_counts(columns).collect()}
    assert found == {"missing_order_dates": 3, "invalid_products": 2}


def test_csv_keeps_blanks_quotes_and_commas(spark, tmp_path):
    rows = [(1, ' A, "b" '), (2, "  "), (3, 'say ""hi""'), (4, None)]
    df = spark.createDataFrame(rows, "k long, v string")
    files.write_csv(df, str(tmp_path / "out"))
    back = files.read_csv_table(spark, str(tmp_path / "out"), df.schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_csv_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "k long, v string")
    with pytest.raises(Exception, match="line break in v"):
        files.write_csv(df, str(tmp_path / "out"))
    files.write_csv(df, str(tmp_path / "out"), multi_line=True)
    back = files.read_csv_table(spark, str(tmp_path / "out"), df.schema, multi_line=True)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a\nb"), (2, "c")]


@pytest.mark.parametrize("row", ["1", "1,2,3"])
def test_csv_rows_of_another_length_fail(spark, tmp_path, row):
    (tmp_path / "t.csv").write_text(f"a,b\n1,2\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_extract(spark, str(tmp_path / "t.csv")).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_extract(spark, str(tmp_path / "t.csv")).select("a").collect()


def test_whole_job(spark, tmp_path):
    from test_star import sources

    extract, sql = sources(spark)
    for first in (False, True):
        report = etl.run(spark, extract, sql, f"{tmp_path}/{first}", database_first=first)
        assert all(r.ok for r in report.collect())


def test_differences_name_the_keys(spark):
    expected = spark.sql("select explode(array(1, 2, 2, 3, 5, null)) as k")
    present = spark.sql("select explode(array(1, 2, 3, 3, 4, null, null)) as k")
    found = {tuple(r) for r in quality.differences(expected, present, "k").collect()}
    assert found == {(2, 2, 1), (3, 1, 2), (4, 0, 1), (5, 1, 0)}
    assert {tuple(r) for r in quality.differences(expected, present, "k", ranges=1).collect()} == found
    assert quality.differences(expected, expected, "k").isEmpty()
    assert quality.differences(expected.limit(0), expected.limit(0), "k").isEmpty()
    many = spark.range(100_000).select((F.col("id") % 50_000).alias("k"))
    lost = many.where("k not in (17, 4711)")
    assert sorted(map(tuple, quality.differences(many, lost, "k").collect())) == [(17, 2, 0), (4711, 2, 0)]
