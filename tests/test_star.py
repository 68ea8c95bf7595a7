import datetime as dt

import pytest

from starloom import schemas as S
from starloom.plans import star_schema
from starloom.plans.star_schema import build_star, build_star_database_first
from starloom.sources import files

D = dt.datetime


def sources(spark, dated=True):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    date = D(1996, 7, 5) if dated else None
    sql = {
        "Orders": frame(
            [
                (1, " A ", 1, D(1996, 7, 4), 1, 10.0),
                (2, "B", None, date, 2, None),
                (3, None, 1, D(1996, 7, 4, 17, 3, 55), None, 1.0),
                (1, " A ", 1, D(1996, 7, 4), 1, 10.0),
            ],
            "OrderID long, CustomerID string, EmployeeID long, OrderDate timestamp_ntz,"
            " ShipVia long, Freight double",
        ),
        "Order Details": frame(
            [(1, 1, 10.0, 2.0, 0.1), (1, 2, 5.0, 1.0, 0.0), (1, 2, 5.0, 1.0, 0.0), (9, 1, 1.0, 1.0, 0.0)],
            "OrderID long, ProductID long, UnitPrice double, Quantity double, Discount double",
        ),
        "Customers": frame(
            [("A", "Alpha", "Al", "Boss", "Berlin", "Germany", "1")],
            "CustomerID string, CompanyName string, ContactName string, ContactTitle string,"
            " City string, Country string, Phone string",
        ),
        "Products": frame(
            [(1, "Tea", 1, "10 boxes", 18.0, 5, 6, 7, None), (2, "Beans", 99, None, 2.0, 1, 2, 3, True)],
            "ProductID long, ProductName string, CategoryID int, QuantityPerUnit string,"
            " UnitPrice double, UnitsInStock int, UnitsOnOrder int, ReorderLevel int,"
            " Discontinued boolean",
        ),
        "Employees": frame(
            [(1, "Ann", "Lee", "Vice President, Sales", "X", "UK"), (2, "Bob", None, "Rep", "Y", "UK")],
            "EmployeeID long, FirstName string, LastName string, Title string, City string,"
            " Country string",
        ),
        "Shippers": frame([(1, "Rapid", "9")], "ShipperID long, CompanyName string, Phone string"),
        "Categories": frame([(1, "Drinks")], "CategoryID int, CategoryName string"),
    }
    extract = {
        "Orders": frame(
            [("1", "A", "2006-04-25 17:03:55", "1", "x"), ("draft", "A", "2006-01-01", "1", "1")],
            "OrderID string, CustomerID string, OrderDate string, ShipVia string, Freight string",
        ),
        "Order Details": frame(
            [("1", "1", "abc", "4", "nan"), ("1.0", "2", "2", "3", None)],
            "OrderID string, ProductID string, UnitPrice string, Quantity string, Discount string",
        ),
        "Products": frame(
            [("3", "Salmon", None, "31.0", "False"), ("TBD", "?", "1", "1", "True"), ("3.7", "Salmon 2", "1", "9", "True")],
            "ProductID string, ProductName string, CategoryID string, UnitPrice string,"
            " Discontinued string",
        ),
        "Employees": frame([("1.0", "Annie", "Lee")], "EmployeeID string, FirstName string, LastName string"),
        "Shippers": frame([("2.5", "Broken", "0"), ("3", "Third", "7")], "ShipperID string, CompanyName string, Phone string"),
    }
    return extract, sql


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_extract_first_fact(spark):
    fact = build_star(*sources(spark, dated=False)).fact_sales
    assert fact.columns == S.FACT_SALES.fieldNames()
    assert [f.dataType for f in fact.schema] == [f.dataType for f in S.FACT_SALES]
    found = rows(fact, "OrderKey", "TimeKey", "CustomerKey", "EmployeeKey", "ShipperKey", "DetailCount")
    assert found == [
        (1, 19960704, "A", 1, 1, 3),
        (1, 19960704, "A", 1, 1, 3),
        (2, 19960101, "B", None, 2, 0),
        (200001, 20060425, "A", None, 1, 2),
        (3, 19960704, None, 1, None, 0),
    ]
    measures = rows(fact, "OrderKey", "TotalQuantity", "AverageDiscount", "TotalLineTotal", "Freight")
    assert measures == [
        (1, 4.0, pytest.approx(0.1 / 3), 28.0, 10.0),
        (1, 4.0, pytest.approx(0.1 / 3), 28.0, 10.0),
        (2, 0.0, 0.0, 0.0, 0.0),
        (200001, 7.0, 0.0, 6.0, 0.0),
        (3, 0.0, 0.0, 0.0, 1.0),
    ]


def test_extract_first_dimensions(spark):
    star = build_star(*sources(spark, dated=False))
    assert rows(star.dim_time, "TimeKey", "date") == [
        (19960101, D(1996, 1, 1)),
        (19960704, D(1996, 7, 4)),
        (19960704, D(1996, 7, 4, 17, 3, 55)),
        (20060425, D(2006, 4, 25, 17, 3, 55)),
    ]
    assert rows(star_schema.day_calendar(star.dim_time), "TimeKey", "date", "year", "month", "day") == [
        (19960101, D(1996, 1, 1), 1996, 1, 1),
        (19960704, D(1996, 7, 4), 1996, 7, 4),
        (20060425, D(2006, 4, 25), 2006, 4, 25),
    ]
    # "3" and "3.7" are one product number; of the two rows the first by name stays.
    assert rows(star.dim_product, *S.DIM_PRODUCT.fieldNames()) == [
        (1, "Tea", 18.0, "Drinks", False),
        (2, "Beans", 2.0, "Unknown", True),
        (3, "Salmon", 31.0, "Unknown", False),
    ]
    assert rows(star.dim_employee, "EmployeeKey", "EmployeeFullName", "Title") == [
        (1, "Annie Lee", None),
        (2, None, "Rep"),
    ]
    assert rows(star.dim_shipper, "ShipperKey", "ShipperName") == [(1, "Rapid"), (3, "Third")]
    for name, df in star.tables().items():
        assert df.columns == S.STAR_TABLES[name].fieldNames(), name


def test_database_first(spark):
    star = build_star_database_first(*sources(spark))
    assert rows(star.fact_sales, "OrderKey", "DetailCount", "TotalLineTotal") == [
        (1, 2, 23.0),
        (2, 0, 0.0),
        (200001, 2, 6.0),
        (3, 0, 0.0),
    ]
    assert [tuple(r) for r in star.dim_time.select("date", "year_month").collect()] == [
        (D(1996, 7, 4), "1996-07"),
        (D(1996, 7, 4, 17, 3, 55), "1996-07"),
        (D(1996, 7, 5), "1996-07"),
        (D(2006, 4, 25, 17, 3, 55), "2006-04"),
    ]
    assert star.dim_customer.columns == [
        "CustomerKey", "CustomerName", "ContactName", "ContactTitle", "CustomerCity",
        "CustomerCountry", "Phone",
    ]
    assert rows(star.dim_product, "ProductKey", "UnitsInStock", "Discontinued", "CategoryName") == [
        (1, 5, None, "Drinks"),
        (2, 1, True, None),
        (3, None, False, None),
    ]
    assert star.dim_categories is None


def test_database_first_insists_on_dates(spark):
    star = build_star_database_first(*sources(spark, dated=False))
    assert star.dim_time.count() == 3
    with pytest.raises(Exception, match="order without a date"):
        star.fact_sales.collect()
    extract, sql = sources(spark)
    bad = spark.createDataFrame([("5", "soon")], "OrderID string, OrderDate string")
    with pytest.raises(Exception, match="not a timestamp: soon"):
        build_star_database_first(extract | {"Orders": bad}, sql).fact_sales.collect()


@pytest.mark.parametrize("first", [False, True])
def test_further_order_columns_can_be_kept(spark, tmp_path, first):
    extract, sql = sources(spark, dated=first)
    extract = extract | {"Orders": extract["Orders"].selectExpr("*", "'sheet' as ShipName")}
    sql = sql | {"Orders": sql["Orders"].selectExpr("*", "1 as Rush")}
    build = build_star_database_first if first else build_star
    fact = build(extract, sql, keep=["ShipName", "Rush"]).fact_sales
    assert fact.columns[-2:] == ["ShipName", "Rush"]
    found = {(r.OrderKey > 200000, r.ShipName, r.Rush) for r in fact.collect()}
    assert found == {(True, "sheet", None), (False, None, "1")}
    from starloom.plans import etl

    etl.run(spark, extract, sql, str(tmp_path), database_first=first, keep=["ShipName"])
    back = files.read_star(spark, str(tmp_path), database_first=first, keep=["ShipName"])
    assert {r.ShipName for r in back.fact_sales.collect()} == {"sheet", None}


def test_dimensions_stand_alone(spark):
    """Each drops rows without a key and repeats, whatever it is given."""
    customers = spark.createDataFrame(
        [("A", "b", "", "", ""), ("A", "a", "", "", ""), (None, "c", "", "", "")],
        "CustomerID string, CompanyName string, City string, Country string, Phone string",
    )
    assert rows(star_schema.dim_customer(customers), "CustomerName") == [("a",)]
    shippers = spark.createDataFrame(
        [(1, "b", ""), (1, "a", ""), (None, "c", "")], "ShipperID long, CompanyName string, Phone string"
    )
    assert rows(star_schema.dim_shipper(shippers), "ShipperName") == [("a",)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_storage_roundtrip(spark, tmp_path, fmt):
    star = build_star(*sources(spark, dated=False))
    files.write_star(star, str(tmp_path), fmt)
    back = files.read_star(spark, str(tmp_path), fmt)
    for name, df in star.tables().items():
        columns = S.STAR_TABLES[name].fieldNames()
        stored = back.tables()[name]
        assert rows(stored, *columns) == rows(df, *columns), name
        assert stored.select(*columns).schema.simpleString() == df.schema.simpleString(), name


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_database_first_storage(spark, tmp_path, fmt):
    from starloom.plans import reports

    star = build_star_database_first(*sources(spark))
    files.write_star(star, str(tmp_path), fmt)
    back = files.read_star(spark, str(tmp_path), fmt, database_first=True)
    for name, df in star.tables().items():
        assert rows(back.tables()[name], *sorted(df.columns)) == rows(df, *sorted(df.columns)), name
    joined = reports.star_join(back)
    assert {"year_month", "ContactName", "ContactTitle"} <= set(joined.columns)
    assert joined.count() == 4
    assert reports.kpis(reports.select_view(back)).first().orders == 4


def test_date_filters_skip_other_years(spark, tmp_path):
    from starloom.plans.reports import Selection, select_view

    files.write_star(build_star(*sources(spark, dated=False)), str(tmp_path))
    star = files.read_star(spark, str(tmp_path))
    view = select_view(star, Selection(date_range=("1996-07-01", "1996-07-31")))
    plan = view.fact._jdf.queryExecution().executedPlan().toString()
    assert "order_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "TimeKey" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert view.fact.count() == 3


def test_building_a_fact_starts_no_job(spark):
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        for dated, build in ((False, build_star), (True, build_star_database_first)):
            build(*sources(spark, dated=dated))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
