"""Build the star schema from merged sources.

Two variants exist. The *extract-first* one keeps repeated orders and gives orders without a
date a default; the *database-first* one removes repeated orders and lines, insists on dates and
carries more columns in some dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions import clean
from starloom.operators.join import lookup
from starloom.operators.merge import (
    drop_null_keys,
    keep_first,
    merge_sources,
    namespace_ids,
    require_below,
)

Sources = Mapping[str, DataFrame | None]
Watch = Callable[[S.SourceTable, DataFrame], DataFrame]

# Order numbers of the two sources overlap, so the extract's are shifted.
_NAMESPACED = ("Orders", "Order Details")


@dataclass(frozen=True)
class Star:
    """The output tables, lazily defined or read back from storage.

    ``dim_day`` is the calendar at day grain, ``known`` what selections are checked against (see
    ``reports.known_values``); reports derive both where they are not stored. ``calendar_from_fact``
    says that the fact holds every date of ``dim_time``, and no other, so that a writer may take the
    calendar from the stored fact instead of reading the orders twice.
    """

    dim_time: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_employee: DataFrame
    dim_shipper: DataFrame
    fact_sales: DataFrame
    dim_categories: DataFrame | None = None
    dim_day: DataFrame | None = None
    known: DataFrame | None = None
    calendar_from_fact: bool = False

    def tables(self) -> dict[str, DataFrame]:
        found = {name: getattr(self, name) for name in S.STAR_TABLES}
        return {name: df for name, df in found.items() if df is not None}


def merge_table(
    table: S.SourceTable,
    extract: Sources,
    sql: Sources,
    dedupe: bool = True,
    id_offset: int = S.DEFAULT_ID_OFFSET,
    strict_dates: bool = False,
    keep: Sequence[str] = (),
    watch: Watch | None = None,
) -> DataFrame:
    """Conform both sources of ``table`` and merge them; a table absent from both is an error.

    ``keep`` names columns beyond the contract to carry along; at least one source has each.
    ``watch`` gets the table and the rows of both sources, before any is dropped, and returns them.
    """
    left, right = extract.get(table.name), sql.get(table.name)
    if left is None and right is None:
        raise ValueError(f"no source offers the table {table.name}")
    if right is not None:
        right = clean.conform(right, table, strict_dates, keep)
    if left is not None:
        if table.name in _NAMESPACED:
            left = namespace_ids(left, "OrderID", id_offset)
            if right is not None:
                right = require_below(right, "OrderID", id_offset)
        left = clean.conform(left, table, strict_dates, keep)
    return merge_sources(left, right, table.key, dedupe, watch and partial(watch, table))


# Dimensions -----------------------------------------------------------------------------------


def _calendar(dates: DataFrame) -> DataFrame:
    date = F.col("date")
    return dates.select(
        clean.date_key(date).alias("TimeKey"),
        "date",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
    )


def dim_time(orders: DataFrame) -> DataFrame:
    """One row per order timestamp, the default date standing in for missing ones.

    The other columns follow from ``date``, so a distinct on it is the full-row distinct.
    """
    return _calendar(orders.select(clean.or_default_date(F.col("OrderDate")).alias("date")).distinct())


def dim_time_sorted(orders: DataFrame) -> DataFrame:
    """Database-first calendar: missing dates left out, a month label added, sorted by date."""
    dates = orders.select(F.col("OrderDate").alias("date")).where("date is not null").distinct()
    return (
        _calendar(dates)
        .withColumn("year_month", clean.month_label(F.col("date")))
        .orderBy("date")
    )


def calendar_of_fact(fact: DataFrame, labelled: bool = False) -> DataFrame:
    """The calendar of a star's orders, from its fact; ``labelled`` is the database-first one."""
    dates = fact.select(F.col("OrderDate").alias("date")).distinct()
    if not labelled:
        return _calendar(dates)
    return _calendar(dates).withColumn("year_month", clean.month_label(F.col("date"))).orderBy("date")


def day_calendar(calendar: DataFrame) -> DataFrame:
    """One row per day of a calendar that may hold several timestamps per day."""
    days = _calendar(calendar.select(clean.midnight(F.col("date")).alias("date")).distinct())
    if "year_month" in calendar.columns:
        days = days.withColumn("year_month", clean.month_label(F.col("date")))
    return days


def _one_per_key(df: DataFrame, key: str, unique: bool) -> DataFrame:
    """Rows with a key, first one per key. ``unique`` says a merge already saw to the latter."""
    keyed = drop_null_keys(df, [key])
    return keyed if unique else keep_first(keyed, [key])


def dim_customer(
    customers: DataFrame, contacts: bool = False, unique: bool = False
) -> DataFrame:
    """Customers by key; the database-first variant adds the contact columns."""
    columns = S.CUSTOMER_CONTACT_COLUMNS if contacts else S.DIM_CUSTOMER.fieldNames()
    renamed = customers.withColumnsRenamed(S.CUSTOMER_NAMES).select(*columns)
    return _one_per_key(renamed, "CustomerKey", unique)


def dim_employee(employees: DataFrame, unique: bool = False) -> DataFrame:
    named = employees.withColumnRenamed("EmployeeID", "EmployeeKey").select(
        "EmployeeKey",
        clean.full_name(F.col("FirstName"), F.col("LastName")).alias("EmployeeFullName"),
        "FirstName",
        "LastName",
        "Title",
        "City",
        "Country",
    )
    return _one_per_key(named, "EmployeeKey", unique)


def dim_shipper(shippers: DataFrame, unique: bool = False) -> DataFrame:
    renamed = shippers.withColumnsRenamed(S.SHIPPER_NAMES).select(*S.DIM_SHIPPER.fieldNames())
    return _one_per_key(renamed, "ShipperKey", unique)


def dim_categories(categories: DataFrame, unique: bool = False) -> DataFrame:
    columns = categories.select("CategoryID", "CategoryName")
    return _one_per_key(columns, "CategoryID", unique)


def _with_category(products: DataFrame, categories: DataFrame, unique: bool) -> DataFrame:
    """Products, one per key, with their category name; categories are unique by key.

    Deduplicated before the join, while the merge's partitioning by product still holds.
    """
    names = dim_categories(categories, unique)
    products = _one_per_key(products, "ProductID", unique)
    return lookup(products, names, "CategoryID", right_grouped=True)


def dim_product(products: DataFrame, categories: DataFrame, unique: bool = False) -> DataFrame:
    """Products with their category name; an unknown category and a missing flag get defaults."""
    return _with_category(products, categories, unique).select(
        F.col("ProductID").alias("ProductKey"),
        "ProductName",
        "UnitPrice",
        F.coalesce("CategoryName", F.lit(S.DEFAULT_CATEGORY)).alias("CategoryName"),
        F.coalesce("Discontinued", F.lit(False)).alias("Discontinued"),
    )


def dim_product_stock(
    products: DataFrame, categories: DataFrame, unique: bool = False
) -> DataFrame:
    """Database-first products: stock columns added, no defaults."""
    return _with_category(products, categories, unique).select(
        F.col("ProductID").alias("ProductKey"), *S.PRODUCT_STOCK_COLUMNS
    )


# Fact -----------------------------------------------------------------------------------------


def with_line_total(details: DataFrame) -> DataFrame:
    """Zero defaults for price, quantity and discount, and the discounted line total."""
    filled = details.withColumns(
        {c: clean.or_zero(F.col(c)) for c in ("UnitPrice", "Quantity", "Discount")}
    )
    total = clean.line_total(F.col("UnitPrice"), F.col("Quantity"), F.col("Discount"))
    return filled.withColumn("LineTotal", total)


def order_detail_summary(details: DataFrame) -> DataFrame:
    """Lines summed up per order; a hot order is mostly added up before the shuffle.

    The average is a sum by the count that there is anyway, as no discount is null: one column less
    to shuffle.
    """
    return (
        with_line_total(details)
        .where(F.col("OrderID").isNotNull())
        .groupBy("OrderID")
        .agg(
            F.count(F.lit(1)).alias("DetailCount"),
            F.sum("Quantity").alias("TotalQuantity"),
            (F.sum("Discount") / F.count(F.lit(1))).alias("AverageDiscount"),
            F.sum("LineTotal").alias("TotalLineTotal"),
        )
    )


def fact_sales(
    orders: DataFrame,
    details: DataFrame,
    default_dates: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per order, orders without lines included with zero measures.

    The lines' sums, one row per order, are shuffled once more for the join, so that Spark can
    split it where one order number repeats very often.
    Without ``default_dates`` an order without a date fails the query. ``keep`` names further
    order columns to carry along.
    """
    joined = lookup(orders, order_detail_summary(details), "OrderID", right_grouped=True)
    date = F.col("OrderDate")
    if default_dates:
        date = clean.or_default_date(date)
    else:
        missing = F.raise_error(F.lit("order without a date")).cast("timestamp_ntz")
        date = F.coalesce(date, missing)
    return joined.withColumn("OrderDate", date).select(
        F.col("OrderID").alias("OrderKey"),
        clean.date_key(F.col("OrderDate")).alias("TimeKey"),
        F.col("CustomerID").alias("CustomerKey"),
        F.col("EmployeeID").alias("EmployeeKey"),
        F.col("ShipVia").alias("ShipperKey"),
        F.coalesce("DetailCount", F.lit(0).cast("bigint")).alias("DetailCount"),
        clean.or_zero(F.col("TotalQuantity")).alias("TotalQuantity"),
        clean.or_zero(F.col("AverageDiscount")).alias("AverageDiscount"),
        clean.or_zero(F.col("TotalLineTotal")).alias("TotalLineTotal"),
        "OrderDate",
        clean.or_zero(F.col("Freight")).alias("Freight"),
        *keep,
    )


# Whole builds ---------------------------------------------------------------------------------


def _merged(extract: Sources, sql: Sources, id_offset: int, watch: Watch | None) -> Callable[..., DataFrame]:
    return partial(merge_table, extract=extract, sql=sql, id_offset=id_offset, watch=watch)


def build_star(
    extract: Sources,
    sql: Sources,
    id_offset: int = S.DEFAULT_ID_OFFSET,
    keep: Sequence[str] = (),
    watch: Watch | None = None,
) -> Star:
    """Extract-first variant: every order and line of both sources is kept.

    ``keep`` names order columns beyond the contract that the fact carries along, as text.
    """
    merged = _merged(extract, sql, id_offset, watch)
    orders = merged(S.ORDERS, dedupe=False, keep=keep)
    details = merged(S.ORDER_DETAILS, dedupe=False)
    categories = merged(S.CATEGORIES)
    return Star(
        dim_time=dim_time(orders),
        dim_customer=dim_customer(merged(S.CUSTOMERS), unique=True),
        dim_product=dim_product(merged(S.PRODUCTS), categories, unique=True),
        dim_employee=dim_employee(merged(S.EMPLOYEES), unique=True),
        dim_shipper=dim_shipper(merged(S.SHIPPERS), unique=True),
        dim_categories=dim_categories(categories, unique=True),
        fact_sales=fact_sales(orders, details, keep=keep),
        calendar_from_fact=True,
    )


def build_star_database_first(
    extract: Sources,
    sql: Sources,
    id_offset: int = S.DEFAULT_ID_OFFSET,
    keep: Sequence[str] = (),
    watch: Watch | None = None,
) -> Star:
    """Database-first variant: repeated orders and lines removed, dates mandatory."""
    merged = _merged(extract, sql, id_offset, watch)
    orders = merged(S.ORDERS, strict_dates=True, keep=keep)
    details = merged(S.ORDER_DETAILS)
    categories = merged(S.CATEGORIES)
    return Star(
        dim_time=dim_time_sorted(orders),
        dim_customer=dim_customer(merged(S.CUSTOMERS), contacts=True, unique=True),
        dim_product=dim_product_stock(merged(S.PRODUCTS), categories, unique=True),
        dim_employee=dim_employee(merged(S.EMPLOYEES), unique=True),
        dim_shipper=dim_shipper(merged(S.SHIPPERS), unique=True),
        fact_sales=fact_sales(orders, details, default_dates=False, keep=keep),
        calendar_from_fact=True,
    )
