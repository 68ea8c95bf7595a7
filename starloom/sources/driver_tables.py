"""The benchmark tables dressed up as the sources of a star build.

Two sources come out of them. The *database* holds all rows, typed. The *extract* holds the rows
one department keeps in spreadsheets: text in every column, spaces in the headers, stray blanks,
words where numbers or dates belong. Order numbers of the two overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import SOURCE_TABLES
from starloom.sources.files import normalise_headers

# Above any order number the tables hold, whatever their size.
ID_OFFSET = 1_000_000_000_000

SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}
_STAR_SOURCES = ("orders", "lineitem", "customer", "supplier", "nation", "region", "part")


def paths(sf_dir: str) -> dict[str, str]:
    """The files a star is built from."""
    return {name: f"{sf_dir}/{name}.parquet" for name in _STAR_SOURCES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _padded(column: str) -> Column:
    return F.concat(F.lit(" "), _text(column), F.lit(" "))


# Database -------------------------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, dated: bool) -> DataFrame:
    urgent = F.col("o_orderpriority") == "1-URGENT"
    undated = (F.col("o_orderstatus") == "O") & urgent
    date = F.col("o_orderdate") if dated else F.when(~undated, F.col("o_orderdate"))
    # Every fiftieth order was entered twice.
    entries = F.when(F.col("o_orderkey") % 50 == 0, 2).otherwise(1)
    # Fifteen customers share an employee, as there are fifteen customers per supplier.
    employee = F.floor(F.col("o_custkey") / 15).cast("bigint")
    orders = table(spark, sf_dir, "orders").withColumn("entry", F.explode(F.sequence(F.lit(1), entries)))
    return orders.select(
        F.col("o_orderkey").alias("OrderID"),
        _text("o_custkey").alias("CustomerID"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", employee).alias("EmployeeID"),
        date.alias("OrderDate"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("ShipVia"),
        (F.col("o_totalprice") * 0.05).alias("Freight"),
        F.col("o_orderstatus").alias("OrderStatus"),
    )


def _order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_partkey").alias("ProductID"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    joined = table(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.select(
        _text("c_custkey").alias("CustomerID"),
        F.col("c_name").alias("CompanyName"),
        F.concat(F.lit("Contact "), _text("c_custkey")).alias("ContactName"),
        F.lit("Buyer").alias("ContactTitle"),
        F.col("c_mktsegment").alias("City"),
        F.col("n_name").alias("Country"),
        F.concat(_text("c_nationkey"), F.lit("-"), _text("c_custkey")).alias("Phone"),
    )


def _employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    joined = table(spark, sf_dir, "supplier").join(
        places, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    last = F.substring_index("s_name", "#", -1)
    senior = F.col("s_acctbal") > 9000
    return joined.select(
        F.col("s_suppkey").alias("EmployeeID"),
        F.substring_index("s_name", "#", 1).alias("FirstName"),
        F.when(F.col("n_name") != "NATION_0", last).alias("LastName"),
        F.when(senior, "Vice President, Sales").otherwise("Sales Representative").alias("Title"),
        F.col("r_name").alias("City"),
        F.col("n_name").alias("Country"),
    )


def _shippers(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.substring("o_orderpriority", 1, 1)
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            number.cast("bigint").alias("ShipperID"),
            F.col("o_orderpriority").substr(F.lit(3), F.length("o_orderpriority")).alias("CompanyName"),
            F.concat(F.lit("555-010"), number).alias("Phone"),
        )
    )


def _category_id() -> Column:
    return F.substring_index("p_brand", "#", -1).cast("bigint")


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(_category_id().alias("CategoryID"), F.col("p_brand").alias("CategoryName"))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("bigint")
    # Promotional parts carry category numbers that no category has.
    promo = F.when(F.col("p_type") == "PROMO", 100).otherwise(0)
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductName"),
        (_category_id() + promo).alias("CategoryID"),
        F.concat(_text("p_size"), F.lit(" per box")).alias("QuantityPerUnit"),
        F.col("p_retailprice").alias("UnitPrice"),
        size.alias("UnitsInStock"),
        (size * 2).alias("UnitsOnOrder"),
        F.lit(10).cast("bigint").alias("ReorderLevel"),
        F.when(size != 1, size > 45).alias("Discontinued"),
    )


ALL = tuple(t.name for t in SOURCE_TABLES)


def database(
    spark: SparkSession, sf_dir: str, dated: bool = False, names: Sequence[str] = ALL
) -> dict[str, DataFrame]:
    """The named source tables, typed; ``dated`` gives every order a date."""
    tables = {
        "Orders": lambda: _orders(spark, sf_dir, dated),
        "Order Details": lambda: _order_details(spark, sf_dir),
        "Customers": lambda: _customers(spark, sf_dir),
        "Products": lambda: _products(spark, sf_dir),
        "Employees": lambda: _employees(spark, sf_dir),
        "Shippers": lambda: _shippers(spark, sf_dir),
        "Categories": lambda: _categories(spark, sf_dir),
    }
    return {name: tables[name]() for name in names}


# Extract --------------------------------------------------------------------------------------


def extract_orders(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """All orders; it names no employees and serves walk-in customers without a key.

    Only larger ones in status P are numbered, the others are drafts.
    """
    priority = F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    # Medium orders carry the time of day they came in.
    date = F.when(priority == "3-MEDIUM", F.concat(day, F.lit(" 17:03:55"))).otherwise(day)
    if not dated:
        date = F.when(priority == "1-URGENT", "unknown").otherwise(date)
    numbered = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") >= 10000)
    return table(spark, sf_dir, "orders").select(
        F.when(numbered, _text("o_orderkey")).otherwise("draft").alias("Order ID"),
        F.when(priority == "5-LOW", "WALK-IN").otherwise(_padded("o_custkey")).alias("Customer ID"),
        date.alias("Order Date"),
        F.substring("o_orderpriority", 1, 1).alias("Ship Via"),
        F.when(priority == "2-HIGH", "n/a").otherwise(_text("o_totalprice")).alias("Freight"),
    )


def extract_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with return flag R, blank quantities on line 7 and a word for some discounts."""
    return (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .select(
            _text("l_orderkey").alias("Order ID"),
            _text("l_partkey").alias("Product ID"),
            _text("l_extendedprice").alias("Unit Price"),
            F.when(F.col("l_linenumber") == 7, "").otherwise(_text("l_quantity")).alias("Quantity"),
            F.when(F.col("l_linestatus") == "O", "none")
            .otherwise(_text("l_discount"))
            .alias("Discount"),
        )
    )


def extract_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers under their names in capitals.

    Machinery ones are prospects, and only those and building ones have a number.
    """
    segment = F.col("c_mktsegment")
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.select(
        F.when(segment == "MACHINERY", F.concat(F.lit("M-"), _text("c_custkey")))
        .when(segment == "BUILDING", _padded("c_custkey"))
        .alias("Customer ID"),
        F.concat(F.lit('"'), F.upper("c_name"), F.lit('", Ltd. ')).alias("Company Name"),
        F.lit("Head Office").alias("City"),
        F.col("n_name").alias("Country"),
        _text("c_nationkey").alias("Phone"),
    )


def extract_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts at a list price of their own; only standard ones up to a size have a number."""
    size = F.col("p_size")
    numbered = (F.col("p_type") == "STANDARD") & (size <= 48)
    return table(spark, sf_dir, "part").select(
        F.when(numbered, _text("p_partkey")).otherwise("TBD").alias("Product ID"),
        F.upper("p_name").alias("Product Name"),
        F.substring_index("p_brand", "#", -1).alias("Category ID"),
        _text("p_retailprice").alias("Unit Price"),
        F.when(size < 10, "True").when(size < 40, "False").alias("Discontinued"),
    )


def extract_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All employees; every fourth key is whole, as spreadsheets write it, the others are broken."""
    joined = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    key, rest = _text("s_suppkey"), F.col("s_suppkey") % 4
    return joined.select(
        F.when(rest == 0, F.concat(key, F.lit(".0")))
        .when(rest == 1, F.concat(key, F.lit(".5")))
        .when(rest == 2, F.concat(F.lit("No. "), key))
        .alias("Employee ID"),
        F.lit("Agent").alias("First Name"),
        _text("s_suppkey").alias("Last Name"),
        F.lit("Agent").alias("Title"),
        F.lit("Field").alias("City"),
        F.col("n_name").alias("Country"),
    )


def extract(
    spark: SparkSession, sf_dir: str, dated: bool = False, names: Sequence[str] = ALL
) -> dict[str, DataFrame]:
    """The department's spreadsheets; it keeps none for shippers and categories."""
    sheets = {
        "Orders": lambda: extract_orders(spark, sf_dir, dated),
        "Order Details": lambda: extract_order_details(spark, sf_dir),
        "Customers": lambda: extract_customers(spark, sf_dir),
        "Products": lambda: extract_products(spark, sf_dir),
        "Employees": lambda: extract_employees(spark, sf_dir),
    }
    return {name: normalise_headers(sheets[name]()) for name in names if name in sheets}
