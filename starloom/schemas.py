"""Table contracts: what each source must offer and what each star table holds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Column kinds a source column may have; functions.clean turns each into one Spark type.
ID = "id"  # numeric identifier, fractions truncated -> bigint
INT_KEY = "int_key"  # numeric key, fractions rejected -> bigint
TEXT_KEY = "text_key"  # trimmed text key -> string
TEXT = "text"
NUMBER = "number"  # tolerant number -> double
COUNT = "count"  # tolerant whole number -> bigint
TIMESTAMP = "timestamp"  # -> timestamp_ntz
FLAG = "flag"  # -> boolean


@dataclass(frozen=True)
class SourceTable:
    """One source table: its key and the columns the star build reads from it."""

    name: str
    key: tuple[str, ...]
    columns: dict[str, str]


ORDERS = SourceTable(
    "Orders",
    ("OrderID",),
    {
        "OrderID": ID,
        "CustomerID": TEXT_KEY,
        "EmployeeID": INT_KEY,
        "OrderDate": TIMESTAMP,
        "ShipVia": INT_KEY,
        "Freight": NUMBER,
    },
)
ORDER_DETAILS = SourceTable(
    "Order Details",
    ("OrderID", "ProductID"),
    {"OrderID": ID, "ProductID": ID, "UnitPrice": NUMBER, "Quantity": NUMBER, "Discount": NUMBER},
)
CUSTOMERS = SourceTable(
    "Customers",
    ("CustomerID",),
    {
        "CustomerID": TEXT_KEY,
        "CompanyName": TEXT,
        "ContactName": TEXT,
        "ContactTitle": TEXT,
        "City": TEXT,
        "Country": TEXT,
        "Phone": TEXT,
    },
)
PRODUCTS = SourceTable(
    "Products",
    ("ProductID",),
    {
        "ProductID": ID,
        "ProductName": TEXT,
        "CategoryID": INT_KEY,
        "QuantityPerUnit": TEXT,
        "UnitPrice": NUMBER,
        "UnitsInStock": COUNT,
        "UnitsOnOrder": COUNT,
        "ReorderLevel": COUNT,
        "Discontinued": FLAG,
    },
)
EMPLOYEES = SourceTable(
    "Employees",
    ("EmployeeID",),
    {
        "EmployeeID": INT_KEY,
        "FirstName": TEXT,
        "LastName": TEXT,
        "Title": TEXT,
        "City": TEXT,
        "Country": TEXT,
    },
)
SHIPPERS = SourceTable(
    "Shippers", ("ShipperID",), {"ShipperID": INT_KEY, "CompanyName": TEXT, "Phone": TEXT}
)
CATEGORIES = SourceTable(
    "Categories", ("CategoryID",), {"CategoryID": INT_KEY, "CategoryName": TEXT}
)

SOURCE_TABLES = (ORDERS, ORDER_DETAILS, CUSTOMERS, PRODUCTS, EMPLOYEES, SHIPPERS, CATEGORIES)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()

DIM_TIME = _struct(TimeKey=_INT, date=T.TimestampNTZType(), year=_INT, month=_INT, day=_INT)
DIM_CUSTOMER = _struct(
    CustomerKey=_STRING,
    CustomerName=_STRING,
    CustomerCity=_STRING,
    CustomerCountry=_STRING,
    Phone=_STRING,
)
DIM_PRODUCT = _struct(
    ProductKey=_LONG,
    ProductName=_STRING,
    UnitPrice=_DOUBLE,
    CategoryName=_STRING,
    Discontinued=T.BooleanType(),
)
DIM_EMPLOYEE = _struct(
    EmployeeKey=_LONG,
    EmployeeFullName=_STRING,
    FirstName=_STRING,
    LastName=_STRING,
    Title=_STRING,
    City=_STRING,
    Country=_STRING,
)
DIM_SHIPPER = _struct(ShipperKey=_LONG, ShipperName=_STRING, Phone=_STRING)
DIM_CATEGORIES = _struct(CategoryID=_LONG, CategoryName=_STRING)
FACT_SALES = _struct(
    OrderKey=_LONG,
    TimeKey=_INT,
    CustomerKey=_STRING,
    EmployeeKey=_LONG,
    ShipperKey=_LONG,
    DetailCount=_LONG,
    TotalQuantity=_DOUBLE,
    AverageDiscount=_DOUBLE,
    TotalLineTotal=_DOUBLE,
    OrderDate=T.TimestampNTZType(),
    Freight=_DOUBLE,
)

STAR_TABLES: dict[str, T.StructType] = {
    "dim_time": DIM_TIME,
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_employee": DIM_EMPLOYEE,
    "dim_shipper": DIM_SHIPPER,
    "dim_categories": DIM_CATEGORIES,
    "fact_sales": FACT_SALES,
}

# The database-first variant writes no categories and adds these columns.
_EXTRA_COLUMNS = {
    "dim_time": _struct(year_month=_STRING),
    "dim_customer": _struct(ContactName=_STRING, ContactTitle=_STRING),
    "dim_product": _struct(
        QuantityPerUnit=_STRING, UnitsInStock=_LONG, UnitsOnOrder=_LONG, ReorderLevel=_LONG
    ),
}
STAR_TABLES_DATABASE_FIRST: dict[str, T.StructType] = {
    name: T.StructType([*schema, *_EXTRA_COLUMNS.get(name, [])])
    for name, schema in STAR_TABLES.items()
    if name != "dim_categories"
}

# The columns the data check demands of each output table, in its order.
REQUIRED_COLUMNS: dict[str, list[str]] = {
    "dim_time": ["TimeKey", "date", "year", "month", "day"],
    "dim_customer": ["CustomerKey", "CustomerName", "CustomerCity", "CustomerCountry", "Phone"],
    "dim_product": ["ProductKey", "ProductName", "UnitPrice", "CategoryName", "Discontinued"],
    "dim_employee": [
        "EmployeeKey",
        "EmployeeFullName",
        "FirstName",
        "LastName",
        "Title",
        "City",
        "Country",
    ],
    "dim_shipper": ["ShipperKey", "ShipperName", "Phone"],
    "fact_sales": [
        "OrderKey",
        "TimeKey",
        "CustomerKey",
        "EmployeeKey",
        "ShipperKey",
        "DetailCount",
        "TotalQuantity",
        "AverageDiscount",
        "TotalLineTotal",
    ],
}

# Columns of the detail listing, in display order.
DETAIL_COLUMNS = [
    "OrderKey",
    "date",
    "CustomerName",
    "CustomerCountry",
    "EmployeeFullName",
    "ShipperName",
    "DetailCount",
    "TotalQuantity",
    "AverageDiscount",
    "Freight",
    "TotalLineTotal",
]

# The measures of a fact that reports treat as numbers.
MEASURES = ["DetailCount", "TotalQuantity", "AverageDiscount", "TotalLineTotal", "Freight"]

# Names of source columns in the star, and the columns of the wider dimensions.
CUSTOMER_NAMES = {
    "CustomerID": "CustomerKey",
    "CompanyName": "CustomerName",
    "City": "CustomerCity",
    "Country": "CustomerCountry",
}
SHIPPER_NAMES = {"ShipperID": "ShipperKey", "CompanyName": "ShipperName"}
CUSTOMER_CONTACT_COLUMNS = [
    "CustomerKey",
    "CustomerName",
    "ContactName",
    "ContactTitle",
    "CustomerCity",
    "CustomerCountry",
    "Phone",
]
PRODUCT_STOCK_COLUMNS = [
    "ProductName",
    "QuantityPerUnit",
    "UnitPrice",
    "UnitsInStock",
    "UnitsOnOrder",
    "ReorderLevel",
    "Discontinued",
    "CategoryName",
]

# Defaults for missing data.
DEFAULT_ORDER_DATE = "1996-01-01"
DEFAULT_CATEGORY = "Unknown"
DEFAULT_ID_OFFSET = 200_000

# Text that a pandas-style CSV reader takes as missing.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
