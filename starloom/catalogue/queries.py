"""Every registered query: ``(spark, sf_dir) -> DataFrame``.

Cleaning, merging and star queries run from the raw tables. Reports run on the stored star,
which the first of them builds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions import clean
from starloom.operators import merge
from starloom.plans import etl, listing, quality, refresh, reports, star_schema
from starloom.plans.reports import Selection
from starloom.plans.star_schema import Star
from starloom.plans.snapshots import Snapshot, Snapshots
from starloom.plans.stored import StoredStars, new_folder, shared_place, source_state
from starloom.sources import driver_tables as D
from starloom.sources import files

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_STARS = StoredStars()
_STARS_DATABASE_FIRST = StoredStars(database_first=True)


def _query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Cut off the last digits of doubles, which depend on the order of addition.

    ``rint`` works on doubles; ``round`` would turn every value into a big decimal.
    """
    scale = 10.0**digits
    return df.withColumns({c: F.rint(F.col(c) * scale) / scale for c in columns})


def _merged(
    spark: SparkSession,
    sf_dir: str,
    table: S.SourceTable,
    dedupe: bool = True,
    dated: bool = False,
) -> DataFrame:
    return star_schema.merge_table(
        table,
        D.extract(spark, sf_dir, dated, [table.name]),
        D.database(spark, sf_dir, dated, [table.name]),
        dedupe=dedupe,
        id_offset=D.ID_OFFSET,
        strict_dates=dated,
    )


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    return star_schema.build_star(
        D.extract(spark, sf_dir), D.database(spark, sf_dir), id_offset=D.ID_OFFSET
    )


def build_star_database_first(spark: SparkSession, sf_dir: str) -> Star:
    return star_schema.build_star_database_first(
        D.extract(spark, sf_dir, dated=True),
        D.database(spark, sf_dir, dated=True),
        id_offset=D.ID_OFFSET,
    )


def _stored(spark: SparkSession, sf_dir: str) -> Star:
    return _STARS.get(spark, D.paths(sf_dir), lambda: build_star(spark, sf_dir))


def _published(spark: SparkSession, sf_dir: str) -> tuple[Snapshots, Snapshot]:
    """The versions of the star of these tables, the latest built from their present state."""
    paths = D.paths(sf_dir)
    snapshots = Snapshots(spark, shared_place(spark, "versions", sorted(paths.items())))
    state = source_state(spark, paths)
    latest = snapshots.latest()
    if latest is None or latest.state != state:
        sources = D.extract(spark, sf_dir), D.database(spark, sf_dir)
        latest = etl.publish(snapshots, *sources, id_offset=D.ID_OFFSET, state=state)
        snapshots.expire(keep=2)
    return snapshots, latest


# Sources and merging --------------------------------------------------------------------------


@_query
def src_file_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer spreadsheet written as CSV, read back as an extract and conformed."""
    path = new_folder(spark, "extract")
    files.write_csv(D.extract_customers(spark, sf_dir), path)
    return clean.conform(files.read_extract(spark, path), S.CUSTOMERS)


@_query
def src_header_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.normalise_headers(D.extract_products(spark, sf_dir))


@_query
def merge_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, S.SHIPPERS)


@_query
def order_id_namespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = files.normalise_headers(D.extract_orders(spark, sf_dir))
    return merge.namespace_ids(sheet, "OrderID", D.ID_OFFSET).select("OrderID", "OrderDate")


@_query
def merge_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, S.ORDERS, dedupe=False)


@_query
def merge_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, S.CUSTOMERS)


@_query
def merge_keep_first_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, S.ORDER_DETAILS)


@_query
def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = clean.conform(D.extract(spark, sf_dir, names=["Employees"])["Employees"], S.EMPLOYEES)
    return merge.drop_null_keys(sheet, ["EmployeeID"])


# Cleaning -------------------------------------------------------------------------------------


@_query
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("string")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit(" "), price, F.lit(" ")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(price, F.lit("e3")))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(price, F.lit(",5")))
        .when(F.col("o_orderstatus") == "F", F.lit("nan"))
        .when(F.col("o_orderstatus") == "O", F.lit(""))
        .otherwise(price)
    )
    return D.table(spark, sf_dir, "orders").select(
        "o_orderkey", clean.number(text).alias("number")
    )


@_query
def coerce_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("event_type") == "error", F.lit("not a date"))
        .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd"))
        .when(F.col("event_type") == "view", F.lit(None).cast("string"))
        .otherwise(F.col("ts").cast("string"))
    )
    parsed = clean.timestamp(text)
    return D.table(spark, sf_dir, "events").select(
        "event_id", parsed.alias("ts"), clean.or_default_date(parsed).alias("ts_or_default")
    )


@_query
def strict_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps written as text, some as days only; a text that is none would fail the query."""
    text = F.when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd")).otherwise(F.col("ts").cast("string"))
    text = F.when(F.col("event_type") != "error", text)
    return D.table(spark, sf_dir, "events").select("event_id", clean.strict_timestamp(text).alias("ts"))


@_query
def fill_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = (
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("double"))
        .when(F.col("l_returnflag") == "A", F.lit("nan").cast("double"))
        .otherwise(F.col("l_quantity"))
    )
    return D.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", clean.or_zero(quantity).alias("quantity")
    )


@_query
def null_token_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = (
        F.when(F.col("c_mktsegment") == "BUILDING", "nan")
        .when(F.col("c_mktsegment") == "MACHINERY", "N/A")
        .when(F.col("c_mktsegment") == "FURNITURE", "None")
        .otherwise(F.col("c_mktsegment"))
    )
    return D.table(spark, sf_dir, "customer").select(
        "c_custkey", clean.null_tokens_to_null(text).alias("segment")
    )


@_query
def key_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = files.normalise_headers(D.extract_customers(spark, sf_dir))
    return sheet.select(clean.text_key(F.col("CustomerID")).alias("CustomerKey"), "CompanyName")


@_query
def nullable_int_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = files.normalise_headers(D.extract_employees(spark, sf_dir))
    return sheet.select("LastName", clean.whole_key(F.col("EmployeeID")).alias("EmployeeKey"))


@_query
def line_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = D.database(spark, sf_dir, names=["Order Details"])["Order Details"]
    lines = star_schema.with_line_total(details).select("OrderID", "ProductID", "LineTotal")
    return _rounded(lines, "LineTotal")


# Star tables ----------------------------------------------------------------------------------


@_query
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_time(_merged(spark, sf_dir, S.ORDERS, dedupe=False))


@_query
def dim_time_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_time_sorted(_merged(spark, sf_dir, S.ORDERS, dated=True))


@_query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_customer(_merged(spark, sf_dir, S.CUSTOMERS), unique=True)


@_query
def dim_customer_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _merged(spark, sf_dir, S.CUSTOMERS)
    return star_schema.dim_customer(customers, contacts=True, unique=True)


@_query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_product(
        _merged(spark, sf_dir, S.PRODUCTS), _merged(spark, sf_dir, S.CATEGORIES), unique=True
    )


@_query
def dim_product_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_product_stock(
        _merged(spark, sf_dir, S.PRODUCTS), _merged(spark, sf_dir, S.CATEGORIES), unique=True
    )


@_query
def dim_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_employee(_merged(spark, sf_dir, S.EMPLOYEES), unique=True)


@_query
def dim_shipper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_shipper(_merged(spark, sf_dir, S.SHIPPERS), unique=True)


@_query
def dim_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_schema.dim_categories(_merged(spark, sf_dir, S.CATEGORIES), unique=True)


@_query
def dim_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-first within one table, on a key that repeats: one supplier per nation."""
    suppliers = D.table(spark, sf_dir, "supplier").select("s_nationkey", "s_name", "s_suppkey")
    return merge.keep_first(suppliers, ["s_nationkey"])


@_query
def order_detail_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = D.database(spark, sf_dir, names=["Order Details"])["Order Details"]
    summary = star_schema.order_detail_summary(details)
    return _rounded(_rounded(summary, "TotalLineTotal"), "AverageDiscount", digits=6)


def _fact_output(fact: DataFrame) -> DataFrame:
    return _rounded(_rounded(fact, "TotalLineTotal"), "AverageDiscount", digits=6)


@_query
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _merged(spark, sf_dir, S.ORDERS, dedupe=False)
    details = _merged(spark, sf_dir, S.ORDER_DETAILS, dedupe=False)
    return _fact_output(star_schema.fact_sales(orders, details))


@_query
def fact_sales_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _merged(spark, sf_dir, S.ORDERS, dated=True)
    details = _merged(spark, sf_dir, S.ORDER_DETAILS)
    fact = star_schema.fact_sales(orders, details, default_dates=False)
    return _fact_output(fact)


@_query
def fact_sales_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with one more order column, which only the database has."""
    sources = [f(spark, sf_dir, names=["Orders", "Order Details"]) for f in (D.extract, D.database)]
    merged = [
        star_schema.merge_table(t, *sources, dedupe=False, id_offset=D.ID_OFFSET, keep=keep)
        for t, keep in ((S.ORDERS, ["OrderStatus"]), (S.ORDER_DETAILS, []))
    ]
    return _fact_output(star_schema.fact_sales(*merged, keep=["OrderStatus"]))


@_query
def star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_output(reports.star_join(_stored(spark, sf_dir)))


@_query
def star_join_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _STARS_DATABASE_FIRST.get(
        spark, D.paths(sf_dir), lambda: build_star_database_first(spark, sf_dir)
    )
    return _fact_output(reports.star_join(star))


@_query
def star_join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.star_join_fanout(_stored(spark, sf_dir))
    return _rounded(rows, "TotalLineTotal", "FanoutLineTotal", "FanoutFreight")


@_query
def dim_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employee dimension through CSV, its key written as a float."""
    path = new_folder(spark, "csv")
    employees = dim_employee(spark, sf_dir)
    files.write_csv(employees.withColumn("EmployeeKey", F.col("EmployeeKey").cast("double")), path)
    return files.read_csv_table(spark, path, S.DIM_EMPLOYEE)


# Filters --------------------------------------------------------------------------------------

_DATES = Selection(date_range=("1996-03-15", "1998-06-30"))
_SWAPPED = Selection(date_range=("1998-06-30", "1996-03-15"))
_COUNTRIES = Selection(countries=["NATION_3", "NATION_7", "NATION_11"])
_EMPLOYEES = Selection(employees=["Supplier 000000003", "Supplier 000000007", "Agent 4"])
_SHIPPERS = Selection(shippers=["HIGH", "LOW"])
_MIXED = Selection(
    date_range=("1996-03-15", "1998-06-30"),
    countries=["NATION_3", "NATION_7", "NATION_11"],
    shippers=["HIGH", "LOW", "NOT SPECIFIED"],
)


def _view(spark: SparkSession, sf_dir: str, selection: Selection = Selection(), **kw):
    return reports.select_view(_stored(spark, sf_dir), selection, **kw)


def _selected(spark: SparkSession, sf_dir: str, selection: Selection) -> DataFrame:
    return _fact_output(reports.selected_rows(_view(spark, sf_dir, selection)))


@_query
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.date_bounds(_stored(spark, sf_dir))


@_query
def filter_domain_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_domain(_stored(spark, sf_dir), "CustomerCountry")


@_query
def filter_domain_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_domain(_stored(spark, sf_dir), "EmployeeFullName")


@_query
def filter_domain_shipper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_domain(_stored(spark, sf_dir), "ShipperName")


@_query
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, _DATES)


@_query
def filter_date_range_swapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, _SWAPPED)


@_query
def filter_country_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, _COUNTRIES)


@_query
def filter_employee_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, _EMPLOYEES)


@_query
def filter_shipper_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(spark, sf_dir, _SHIPPERS)


@_query
def filter_all_selected_is_noop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every country picked: facts without a country stay."""
    return _selected(spark, sf_dir, Selection(countries=[f"NATION_{i}" for i in range(25)]))


# Answers --------------------------------------------------------------------------------------


@_query
def kpi_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.kpis(_view(spark, sf_dir)), "revenue", "average_basket")


@_query
def kpi_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.kpis(_view(spark, sf_dir, _MIXED)), "revenue", "average_basket")


@_query
def kpi_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures as they come out on the calendar with several timestamps per day."""
    view = _view(spark, sf_dir, _DATES, calendar="timestamp")
    return _rounded(reports.kpis(view), "revenue", "average_basket")


@_query
def revenue_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.revenue_by_month(_view(spark, sf_dir)), "CA")


@_query
def revenue_by_month_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per month as it comes out on the calendar with several timestamps per day."""
    view = _view(spark, sf_dir, calendar="timestamp")
    return _rounded(reports.revenue_by_month(view), "CA")


@_query
def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.top_countries(_view(spark, sf_dir)), "CA")


@_query
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.top_customers(_view(spark, sf_dir)), "CA")


@_query
def top_customers_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.top_customers(_view(spark, sf_dir, _MIXED)), "CA")


@_query
def top_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.top_employees(_view(spark, sf_dir)), "CA")


@_query
def freight_by_shipper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reports.freight_by_shipper(_view(spark, sf_dir)), "Freight")


@_query
def answer_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All key figures and breakdowns at once, from one pass over the fact."""
    view, path = _view(spark, sf_dir), new_folder(spark, "answers")
    reports.partial_answers(view).write.parquet(path)
    return _rounded(reports.answers_from(view, spark.read.parquet(path)), "value")


@_query
def detail_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reports.detail_table(_view(spark, sf_dir))
    return _fact_output(rows)


@_query
def detail_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of the stored listing, of a hundred rows."""
    path = new_folder(spark, "listing")
    listing.store(_view(spark, sf_dir), path)
    return _fact_output(listing.page(spark, path, 2, 100))


@_query
def detail_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail listing of a filtered view through its CSV export."""
    path = new_folder(spark, "detail")
    rows = _fact_output(reports.detail_table(_view(spark, sf_dir, _MIXED)))
    files.write_csv(rows, path)
    return files.read_csv_table(spark, path, rows.schema)


# Quality --------------------------------------------------------------------------------------


def _stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | None]:
    path = _STARS.path(spark, D.paths(sf_dir), lambda: build_star(spark, sf_dir))
    return files.stored_tables(spark, path)


@_query
def dq_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.contract(spark, _stored_tables(spark, sf_dir))


@_query
def dq_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(_stored_tables(spark, sf_dir))


@_query
def dq_merged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the two large tables after merging."""
    merged = {t.name: _merged(spark, sf_dir, t, dedupe=False) for t in (S.ORDERS, S.ORDER_DETAILS)}
    return quality.row_counts(merged)


@_query
def dq_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over both sources, before anything is dropped for want of a key."""
    columns = {
        "missing_order_dates": (S.ORDERS, "OrderDate"),
        "invalid_products": (S.PRODUCTS, "ProductID"),
        "rejected_employee_keys": (S.EMPLOYEES, "EmployeeID"),
    }
    merged = {m: (_merged(spark, sf_dir, t, dedupe=False), c) for m, (t, c) in columns.items()}
    return quality.null_counts(merged)


@_query
def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of either source that can't be read, from rows stored together with their quarantine."""
    folder, stored = new_folder(spark, "conformed"), {}
    sources = {"extract": D.extract(spark, sf_dir), "database": D.database(spark, sf_dir)}
    for source, tables in sources.items():
        for table in S.SOURCE_TABLES:
            if table.name in tables:
                path = f"{folder}/{source}/{table.name.replace(' ', '_')}"
                clean.conform_with_rejects(tables[table.name], table).write.parquet(path)
                stored[source, table.name] = spark.read.parquet(path)
    return quality.rejected(quality.quarantine(stored))


@_query
def dq_order_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _merged(spark, sf_dir, S.ORDERS, dedupe=False)
    return quality.order_gap(orders, _stored(spark, sf_dir).fact_sales)


@_query
def dq_order_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders behind the gap, each with how many facts it should have and has."""
    orders = _merged(spark, sf_dir, S.ORDERS, dedupe=False)
    return quality.order_differences(orders, _stored(spark, sf_dir).fact_sales)


@_query
def dq_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.preview(_stored_tables(spark, sf_dir))


@_query
def dq_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(quality.contract(spark, _stored_tables(spark, sf_dir)))


def _broken_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | None]:
    tables = _stored_tables(spark, sf_dir)
    return tables | {"dim_shipper": None, "dim_product": tables["dim_product"].drop("UnitPrice")}


@_query
def dq_contract_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same star without one table and without a column of another."""
    return quality.contract(spark, _broken_tables(spark, sf_dir))


@_query
def dq_verdict_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdict(quality.contract(spark, _broken_tables(spark, sf_dir)))


@_query
def source_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of the customers' names as text files, and of a path that isn't there."""
    path = new_folder(spark, "text")
    D.table(spark, sf_dir, "customer").select("c_name").write.text(path)
    found = files.fingerprint(spark, {"customer": path, "nothing": f"{path}-absent"})
    return found.select(
        "table_name",
        "byte_count",
        (F.col("file_count") > 0).alias("has_files"),
        F.col("last_modified").isNotNull().alias("is_dated"),
    )


@_query
def dq_build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was counted while the latest version was written: no table is scanned for it."""
    return quality.listed(spark, _published(spark, sf_dir)[1].counts)


@_query
def published_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the latest published version."""
    snapshots, latest = _published(spark, sf_dir)
    return _fact_output(snapshots.tables(latest)["fact_sales"])


@_query
def published_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the latest published version, taken from its fact."""
    snapshots, latest = _published(spark, sf_dir)
    return snapshots.star(latest).dim_time


def _delivered(spark: SparkSession, sf_dir: str, first: bool, root: str) -> refresh.SourceFiles:
    """Both sources as files, the orders and lines of a first and of a later delivery apart.

    The later one has the orders whose number divides by 50, and their lines.
    """
    places: dict[str, dict[str, str]] = {refresh.EXTRACT: {}, refresh.DATABASE: {}}
    tables = {refresh.EXTRACT: D.extract(spark, sf_dir), refresh.DATABASE: D.database(spark, sf_dir)}
    for side, found in tables.items():
        for name, df in found.items():
            places[side][name] = f"{root}/{side}/{name.replace(' ', '_')}"
            if name in (S.ORDERS.name, S.ORDER_DETAILS.name):
                number = F.expr("coalesce(try_cast(OrderID AS bigint), 1)")
                df = df.where((number % 50 != 0) if first else (number % 50 == 0))
            elif not first:
                continue
            df.write.mode("append").parquet(places[side][name])
    return refresh.SourceFiles(places[refresh.EXTRACT], places[refresh.DATABASE], extract_format="parquet")


@_query
def refreshed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a later delivery of orders and lines, taken up by a refresh."""
    root = new_folder(spark, "deliveries")
    snapshots = Snapshots(spark, f"{root}/star")
    for first in (True, False):
        sources = _delivered(spark, sf_dir, first, root)
        done = refresh.refresh(snapshots, sources, id_offset=D.ID_OFFSET)
    return _fact_output(snapshots.tables(done)["fact_sales"])


# Beyond the reference's own queries: integrity and shares ---------------------------------------


@_query
def x_orphan_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose key no dimension row has, per dimension."""
    return quality.orphans(_stored(spark, sf_dir))


@_query
def x_dim_key_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct keys of every dimension."""
    return quality.key_counts(_stored_tables(spark, sf_dir))


@_query
def x_freight_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freight per shipper as a share of all freight shown."""
    freight = reports.freight_by_shipper(_view(spark, sf_dir))
    return _rounded(reports.with_share(freight, "Freight"), "Freight", "Share")


@_query
def x_category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per product category, from the merged lines."""
    star = _stored(spark, sf_dir)
    lines = star_schema.with_line_total(_merged(spark, sf_dir, S.ORDER_DETAILS, dedupe=False))
    return _rounded(reports.revenue_by_category(lines, star.dim_product), "CA")
