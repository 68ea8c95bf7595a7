"""The registered queries in SQL, written against the raw tables."""

from __future__ import annotations

_OFFSET = 1_000_000_000_000

# Common table expressions, each usable after the ones it names.
_DEFINITIONS: dict[str, tuple[tuple[str, ...], str]] = {}


def _define(name: str, needs: str, sql: str) -> None:
    _DEFINITIONS[name] = (tuple(needs.split()), sql)


def _with(needs: str, select: str) -> str:
    """``select`` preceded by the expressions it needs, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in _DEFINITIONS[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        add(name)
    if not ordered:
        return select
    parts = [f"{name} AS ({_DEFINITIONS[name][1]})" for name in ordered]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _money(column: str) -> str:
    return f"cast(coalesce(sum(cast({column} AS decimal(30,6))), 0) AS double)"


# Sources --------------------------------------------------------------------------------------

_ORDER_COLUMNS = """
    cast(o_custkey AS varchar) AS CustomerID,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey // 15 END AS EmployeeID,
    cast(substr(o_orderpriority, 1, 1) AS bigint) AS ShipVia,
    o_totalprice * cast(0.05 AS double) AS Freight
"""
_SHEET_ORDER_COLUMNS = f"""
    o_orderkey + {_OFFSET} AS OrderID,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'WALK-IN' ELSE cast(o_custkey AS varchar) END
        AS CustomerID,
    cast(NULL AS bigint) AS EmployeeID,
    cast(substr(o_orderpriority, 1, 1) AS bigint) AS ShipVia,
    CASE WHEN o_orderpriority <> '2-HIGH' THEN o_totalprice END AS Freight,
    CASE WHEN o_orderpriority = '3-MEDIUM'
         THEN o_orderdate + INTERVAL '17 hours 3 minutes 55 seconds'
         ELSE o_orderdate END AS full_date
"""
_define(
    "merged_orders",
    "",
    f"""
    SELECT OrderID, CustomerID, EmployeeID, OrderDate, ShipVia, Freight FROM (
        SELECT {_SHEET_ORDER_COLUMNS},
               CASE WHEN o_orderpriority <> '1-URGENT' THEN full_date END AS OrderDate
        FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 10000)
    UNION ALL
    SELECT OrderID, CustomerID, EmployeeID, OrderDate, ShipVia, Freight FROM (
        SELECT o_orderkey AS OrderID, {_ORDER_COLUMNS},
               CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')
                    THEN o_orderdate END AS OrderDate
        FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0))
    """,
)
_define(
    "dated_orders",
    "",
    f"""
    SELECT OrderID, CustomerID, EmployeeID, full_date AS OrderDate, ShipVia, Freight FROM (
        SELECT {_SHEET_ORDER_COLUMNS} FROM orders
        WHERE o_orderstatus = 'P' AND o_totalprice >= 10000)
    UNION ALL
    SELECT OrderID, CustomerID, EmployeeID, OrderDate, ShipVia, Freight FROM (
        SELECT o_orderkey AS OrderID, {_ORDER_COLUMNS}, o_orderdate AS OrderDate FROM orders)
    """,
)
_SHEET_DETAILS = f"""
    SELECT l_orderkey + {_OFFSET} AS OrderID, l_partkey AS ProductID,
           l_extendedprice AS UnitPrice,
           CASE WHEN l_linenumber <> 7 THEN l_quantity END AS Quantity,
           CASE WHEN l_linestatus <> 'O' THEN l_discount END AS Discount
    FROM lineitem WHERE l_returnflag = 'R'
"""
_DATABASE_DETAILS = """
    SELECT l_orderkey AS OrderID, l_partkey AS ProductID,
           l_extendedprice / l_quantity AS UnitPrice, l_quantity AS Quantity,
           l_discount AS Discount
    FROM lineitem
"""
_define("database_details", "", _DATABASE_DETAILS)
_define("merged_details", "", f"{_SHEET_DETAILS} UNION ALL {_DATABASE_DETAILS}")
_define(
    "unique_details",
    "merged_details",
    """
    SELECT OrderID, ProductID, UnitPrice, Quantity, Discount FROM (
        SELECT *, row_number() OVER (
            PARTITION BY OrderID, ProductID
            ORDER BY UnitPrice NULLS LAST, Quantity NULLS LAST, Discount NULLS LAST) AS r
        FROM merged_details)
    WHERE r = 1
    """,
)
_define(
    "merged_customers",
    "",
    """
    SELECT CustomerID, CompanyName, ContactName, ContactTitle, City, Country, Phone FROM (
        SELECT *, row_number() OVER (PARTITION BY CustomerID ORDER BY src) AS r FROM (
            SELECT 0 AS src,
                   CASE WHEN c_mktsegment = 'MACHINERY' THEN 'M-' || c_custkey
                        ELSE cast(c_custkey AS varchar) END AS CustomerID,
                   '"' || upper(c_name) || '", Ltd. ' AS CompanyName, NULL AS ContactName, NULL AS ContactTitle,
                   'Head Office' AS City, n_name AS Country, cast(c_nationkey AS varchar) AS Phone
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
            WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
            UNION ALL
            SELECT 1, cast(c_custkey AS varchar), c_name, 'Contact ' || c_custkey, 'Buyer',
                   c_mktsegment, n_name, c_nationkey || '-' || c_custkey
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey))
    WHERE r = 1
    """,
)
_define(
    "merged_products",
    "",
    """
    SELECT * EXCLUDE (src, r) FROM (
        SELECT *, row_number() OVER (PARTITION BY ProductID ORDER BY src) AS r FROM (
            SELECT 0 AS src, p_partkey AS ProductID, upper(p_name) AS ProductName,
                   cast(substr(p_brand, 7) AS bigint) AS CategoryID,
                   NULL AS QuantityPerUnit, p_retailprice AS UnitPrice,
                   cast(NULL AS bigint) AS UnitsInStock, cast(NULL AS bigint) AS UnitsOnOrder,
                   cast(NULL AS bigint) AS ReorderLevel,
                   CASE WHEN p_size < 10 THEN true WHEN p_size < 40 THEN false END AS Discontinued
            FROM part WHERE p_type = 'STANDARD' AND p_size <= 48
            UNION ALL
            SELECT 1, p_partkey, p_name,
                   cast(substr(p_brand, 7) AS bigint)
                       + CASE WHEN p_type = 'PROMO' THEN 100 ELSE 0 END,
                   p_size || ' per box', p_retailprice, p_size, p_size * 2, 10,
                   CASE WHEN p_size <> 1 THEN p_size > 45 END
            FROM part))
    WHERE r = 1
    """,
)
_define(
    "categories",
    "",
    "SELECT DISTINCT cast(substr(p_brand, 7) AS bigint) AS CategoryID, p_brand AS CategoryName"
    " FROM part",
)
_define(
    "sheet_employees",
    "",
    """
    SELECT CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey END AS EmployeeID,
           'Agent' AS FirstName, cast(s_suppkey AS varchar) AS LastName, 'Agent' AS Title,
           'Field' AS City, n_name AS Country
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    """,
)

# Star tables ----------------------------------------------------------------------------------

_CALENDAR_COLUMNS = """
    cast(strftime(date, '%Y%m%d') AS int) AS TimeKey, date, cast(year(date) AS int) AS year,
    cast(month(date) AS int) AS month, cast(day(date) AS int) AS day
"""
_define(
    "dim_time",
    "merged_orders",
    f"""
    SELECT {_CALENDAR_COLUMNS} FROM (
        SELECT DISTINCT coalesce(OrderDate, TIMESTAMP '1996-01-01') AS date FROM merged_orders)
    """,
)
_define(
    "dim_day",
    "dim_time",
    f"""
    SELECT {_CALENDAR_COLUMNS} FROM (
        SELECT DISTINCT cast(cast(date AS date) AS timestamp) AS date FROM dim_time)
    """,
)
_define(
    "dim_customer",
    "merged_customers",
    """
    SELECT CustomerID AS CustomerKey, CompanyName AS CustomerName, City AS CustomerCity,
           Country AS CustomerCountry, Phone
    FROM merged_customers
    """,
)
_define(
    "dim_employee",
    "sheet_employees",
    """
    SELECT EmployeeID AS EmployeeKey, FirstName || ' ' || LastName AS EmployeeFullName,
           FirstName, LastName, Title, City, Country
    FROM (
        SELECT *, row_number() OVER (PARTITION BY EmployeeID ORDER BY src) AS r FROM (
            SELECT 0 AS src, * FROM sheet_employees
            UNION ALL
            SELECT 1, s_suppkey, split_part(s_name, '#', 1),
                   CASE WHEN n_name <> 'NATION_0' THEN split_part(s_name, '#', 2) END,
                   CASE WHEN s_acctbal > 9000 THEN 'Vice President, Sales'
                        ELSE 'Sales Representative' END,
                   r_name, n_name
            FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                          LEFT JOIN region ON n_regionkey = r_regionkey)
        WHERE EmployeeID IS NOT NULL)
    WHERE r = 1
    """,
)
_define(
    "dim_shipper",
    "",
    """
    SELECT DISTINCT cast(substr(o_orderpriority, 1, 1) AS bigint) AS ShipperKey,
           substr(o_orderpriority, 3) AS ShipperName,
           '555-010' || substr(o_orderpriority, 1, 1) AS Phone
    FROM orders
    """,
)
_define(
    "dim_product",
    "merged_products categories",
    """
    SELECT ProductID AS ProductKey, ProductName, UnitPrice,
           coalesce(CategoryName, 'Unknown') AS CategoryName,
           coalesce(Discontinued, false) AS Discontinued
    FROM merged_products LEFT JOIN categories USING (CategoryID)
    """,
)


def _summary(details: str) -> str:
    total = "coalesce(UnitPrice, 0) * coalesce(Quantity, 0) * (1 - coalesce(Discount, 0))"
    return f"""
        SELECT OrderID, count(*) AS DetailCount, sum(coalesce(Quantity, 0)) AS TotalQuantity,
               avg(coalesce(Discount, 0)) AS AverageDiscount, sum({total}) AS TotalLineTotal
        FROM {details} GROUP BY OrderID
    """


def _fact(orders: str, summary: str) -> str:
    return f"""
        SELECT OrderID AS OrderKey, cast(strftime(OrderDate, '%Y%m%d') AS int) AS TimeKey,
               CustomerID AS CustomerKey, EmployeeID AS EmployeeKey, ShipVia AS ShipperKey,
               coalesce(DetailCount, 0) AS DetailCount,
               coalesce(TotalQuantity, 0) AS TotalQuantity,
               coalesce(AverageDiscount, 0) AS AverageDiscount,
               coalesce(TotalLineTotal, 0) AS TotalLineTotal,
               OrderDate, coalesce(Freight, 0) AS Freight
        FROM (SELECT * REPLACE (coalesce(OrderDate, TIMESTAMP '1996-01-01') AS OrderDate)
              FROM {orders})
        LEFT JOIN {summary} USING (OrderID)
    """


_define("detail_summary", "merged_details", _summary("merged_details"))
_define("database_summary", "database_details", _summary("database_details"))
_define("unique_summary", "unique_details", _summary("unique_details"))
_define("fact", "merged_orders detail_summary", _fact("merged_orders", "detail_summary"))
_define("fact_s", "dated_orders unique_summary", _fact("dated_orders", "unique_summary"))


def _star(fact: str, days: str, customers: str, more: str) -> str:
    return f"""
        SELECT f.*, d.date, d.year, d.month, d.day,
               c.CustomerName, c.CustomerCity, c.CustomerCountry, c.Phone AS CustomerPhone,
               e.EmployeeFullName, e.FirstName, e.LastName, e.Title, e.City, e.Country,
               s.ShipperName, s.Phone AS ShipperPhone {more}
        FROM {fact} f
        LEFT JOIN {days} d ON f.TimeKey = d.TimeKey
        LEFT JOIN {customers} c ON f.CustomerKey = c.CustomerKey
        LEFT JOIN dim_employee e ON f.EmployeeKey = e.EmployeeKey
        LEFT JOIN dim_shipper s ON f.ShipperKey = s.ShipperKey
    """


_define(
    "star",
    "fact dim_day dim_customer dim_employee dim_shipper",
    _star("fact", "dim_day", "dim_customer", ""),
)
_define(
    "dim_day_s",
    "dated_orders",
    f"""
    SELECT {_CALENDAR_COLUMNS} FROM (
        SELECT DISTINCT cast(cast(OrderDate AS date) AS timestamp) AS date FROM dated_orders)
    """,
)
_define(
    "dim_customer_s",
    "merged_customers",
    """
    SELECT CustomerID AS CustomerKey, CompanyName AS CustomerName, ContactName, ContactTitle,
           City AS CustomerCity, Country AS CustomerCountry, Phone
    FROM merged_customers
    """,
)
_define(
    "star_s",
    "fact_s dim_day_s dim_customer_s dim_employee dim_shipper",
    _star(
        "fact_s",
        "dim_day_s",
        "dim_customer_s",
        ", c.ContactName, c.ContactTitle, strftime(d.date, '%Y-%m') AS year_month",
    ),
)

_ROUNDED_MEASURES = """
    round(TotalLineTotal, 4) AS TotalLineTotal, round(AverageDiscount, 6) AS AverageDiscount
"""
_ROUNDED = f"* REPLACE ({_ROUNDED_MEASURES})"
_DATE_FILTER = "date BETWEEN TIMESTAMP '1996-03-15' AND TIMESTAMP '1998-06-30'"
_COUNTRY_FILTER = "CustomerCountry IN ('NATION_3', 'NATION_7', 'NATION_11')"
_MIXED = f"{_DATE_FILTER} AND {_COUNTRY_FILTER} AND ShipperName IN ('HIGH', 'LOW', 'NOT SPECIFIED')"


def _selected(condition: str) -> str:
    return _with("star", f"SELECT {_ROUNDED} FROM star WHERE {condition}")


def _by_month(rows: str, condition: str) -> str:
    return f"""SELECT year, month, round({_money("TotalLineTotal")}, 4) AS CA,
                      make_date(year, month, 1) AS Mois
               FROM {rows} WHERE {condition} GROUP BY year, month"""


def _detail(condition: str) -> str:
    return _with(
        "star",
        f"""SELECT OrderKey, date, CustomerName, CustomerCountry, EmployeeFullName,
                   ShipperName, DetailCount, TotalQuantity, Freight, {_ROUNDED_MEASURES}
            FROM star WHERE {condition}""",
    )


def _domain(column: str) -> str:
    return _with("star", f"SELECT DISTINCT {column} FROM star WHERE {column} IS NOT NULL")


def _top(column: str, condition: str = "date IS NOT NULL") -> str:
    return _with(
        "star",
        f"""SELECT {column}, round({_money("TotalLineTotal")}, 4) AS CA FROM star
            WHERE {column} IS NOT NULL AND {condition}
            GROUP BY {column} ORDER BY {_money("TotalLineTotal")} DESC, {column} LIMIT 10""",
    )


_KPI = f"""
    SELECT round(revenue, 4) AS revenue, orders, customers,
           round(coalesce(revenue / nullif(selected, 0), 0), 4) AS average_basket
    FROM (SELECT {_money("TotalLineTotal")} AS revenue, count(DISTINCT OrderKey) AS selected,
                 {{orders}} AS orders, {{customers}} AS customers
          FROM {{rows}} WHERE {{condition}})
"""

_TABLE_COLUMNS = {
    "dim_time": 5,
    "dim_customer": 5,
    "dim_product": 5,
    "dim_employee": 7,
    "dim_shipper": 3,
    "fact": 11,
}


def _name(table: str) -> str:
    return "fact_sales" if table == "fact" else table


def _contract() -> str:
    return " UNION ALL ".join(
        f"SELECT '{_name(t)}' AS table_name, true AS present, '' AS missing_columns,"
        f" count(*) AS row_count, cast({n} AS int) AS column_count, true AS ok FROM {t}"
        for t, n in _TABLE_COLUMNS.items()
    )


def _preview() -> str:
    shown = {
        "dim_time": ["TimeKey", "date", "year", "month", "day"],
        "dim_customer": ["CustomerKey", "CustomerName", "CustomerCity", "CustomerCountry", "Phone"],
        "dim_product": ["ProductKey", "ProductName", "UnitPrice", "CategoryName", "Discontinued"],
        "dim_employee": ["EmployeeKey", "EmployeeFullName", "FirstName", "LastName", "Title"],
        "dim_shipper": ["ShipperKey", "ShipperName", "Phone"],
        "fact": ["OrderKey", "TimeKey", "CustomerKey", "EmployeeKey", "ShipperKey"],
    }
    parts = []
    for table, columns in shown.items():
        names = ", ".join(columns)
        for column in columns:
            parts.append(
                f"SELECT '{_name(table)}' AS table_name, '{column}' AS column_name,"
                f" cast({column} AS varchar) AS value FROM"
                f" (SELECT {names} FROM {table} ORDER BY {names} LIMIT 3)"
            )
    return " UNION ALL ".join(parts)


_STAR_TABLES = " ".join(_TABLE_COLUMNS)
_DIMENSION_KEYS = {
    "dim_time": "TimeKey",
    "dim_customer": "CustomerKey",
    "dim_employee": "EmployeeKey",
    "dim_shipper": "ShipperKey",
    "dim_product": "ProductKey",
}


def _build_counts(sql: dict[str, str]) -> str:
    """Rows of every table of the star and of every merged source, and the values that are missing."""
    twice = {"Customers": "customer", "Products": "part", "Employees": "supplier"}
    once = {"Shippers": "o_orderpriority) FROM orders", "Categories": "p_brand) FROM part"}
    return " UNION ALL ".join([
        f"SELECT table_name AS metric, row_count FROM ({sql['dq_row_counts']})",
        f"SELECT * FROM ({sql['dq_merged_counts']})",
        f"SELECT * FROM ({sql['dq_null_counts']})",
        *(f"SELECT '{name}', 2 * count(*) FROM {table}" for name, table in twice.items()),
        *(f"SELECT '{name}', count(DISTINCT {rest}" for name, rest in once.items()),
    ])


def _answers(sql: dict[str, str]) -> str:
    """The single reports' rows, side by side."""
    parts = []
    for column, name, value in (
        ("month", "cast(Mois AS varchar)", "revenue_by_month"), ("country", "CustomerCountry", "top_countries"),
        ("customer", "CustomerName", "top_customers"), ("employee", "EmployeeFullName", "top_employees"),
    ):
        parts.append(f"SELECT '{column}' AS tile, {name} AS name, CA AS value FROM ({sql[value]})")
    parts.append(f"SELECT 'shipper', ShipperName, Freight FROM ({sql['freight_by_shipper']})")
    kpis = "orders", "customers", "revenue", "average_basket"
    parts += [f"SELECT 'total', '{k}', cast({k} AS double) FROM ({sql['kpi_unfiltered']})" for k in kpis]
    return " UNION ALL ".join(parts)


def all_sql() -> dict[str, str]:
    sql = _single_sql()
    sql["dq_build_counts"] = _build_counts(sql)
    sql["published_fact"], sql["published_calendar"] = sql["fact_sales"], sql["dim_time"]
    sql["refreshed_fact"] = sql["fact_sales"]
    sql["answer_set"] = _answers(sql)
    return sql


def _single_sql() -> dict[str, str]:
    return {
        "src_file_extract": """
            SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'M-' || c_custkey
                                     WHEN 'BUILDING' THEN cast(c_custkey AS varchar) END AS CustomerID,
                   '"' || upper(c_name) || '", Ltd. ' AS CompanyName, 'Head Office' AS City,
                   n_name AS Country, cast(c_nationkey AS varchar) AS Phone
            FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
        "src_header_normalise": """
            SELECT CASE WHEN p_type = 'STANDARD' AND p_size <= 48
                        THEN cast(p_partkey AS varchar) ELSE 'TBD' END AS ProductID,
                   upper(p_name) AS ProductName, substr(p_brand, 7) AS CategoryID,
                   cast(p_retailprice AS varchar) AS UnitPrice,
                   CASE WHEN p_size < 10 THEN 'True' WHEN p_size < 40 THEN 'False' END
                       AS Discontinued
            FROM part""",
        "merge_single_source": _with(
            "dim_shipper",
            "SELECT ShipperKey AS ShipperID, ShipperName AS CompanyName, Phone FROM dim_shipper",
        ),
        "order_id_namespace": f"""
            SELECT o_orderkey + {_OFFSET} AS OrderID,
                   CASE WHEN o_orderpriority = '1-URGENT' THEN 'unknown'
                        WHEN o_orderpriority = '3-MEDIUM'
                        THEN strftime(o_orderdate, '%Y-%m-%d') || ' 17:03:55'
                        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS OrderDate
            FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 10000""",
        "merge_union_all": _with("merged_orders", "SELECT * FROM merged_orders"),
        "merge_keep_first": _with("merged_customers", "SELECT * FROM merged_customers"),
        "merge_keep_first_composite": _with("unique_details", "SELECT * FROM unique_details"),
        "drop_null_keys": _with(
            "sheet_employees", "SELECT * FROM sheet_employees WHERE EmployeeID IS NOT NULL"
        ),
        "coerce_numeric": """
            SELECT o_orderkey,
                   CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice
                        WHEN o_orderpriority = '2-HIGH'
                        THEN try_cast(cast(o_totalprice AS varchar) || 'e3' AS double)
                        WHEN o_orderpriority = '3-MEDIUM' OR o_orderstatus IN ('F', 'O') THEN NULL
                        ELSE o_totalprice END AS number
            FROM orders""",
        "coerce_timestamp": """
            SELECT event_id, t AS ts, coalesce(t, TIMESTAMP '1996-01-01') AS ts_or_default FROM (
                SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL
                                      WHEN event_type = 'click' THEN date_trunc('day', ts)
                                      ELSE ts END AS t
                FROM events)""",
        "fill_defaults": """
            SELECT l_orderkey, l_linenumber,
                   CASE WHEN l_returnflag IN ('R', 'A') THEN cast(0 AS double)
                        ELSE l_quantity END AS quantity
            FROM lineitem""",
        "null_token_clean": """
            SELECT c_custkey,
                   CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'FURNITURE')
                        THEN c_mktsegment END AS segment
            FROM customer""",
        "key_trim": """
            SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'M-' || c_custkey
                                     WHEN 'BUILDING' THEN cast(c_custkey AS varchar) END AS CustomerKey,
                   '"' || upper(c_name) || '", Ltd. ' AS CompanyName
            FROM customer""",
        "nullable_int_key": _with(
            "sheet_employees", "SELECT LastName, EmployeeID AS EmployeeKey FROM sheet_employees"
        ),
        "line_total": _with(
            "database_details",
            "SELECT OrderID, ProductID, round(UnitPrice * Quantity * (1 - Discount), 4)"
            " AS LineTotal FROM database_details",
        ),
        "dim_time": _with("dim_time", "SELECT * FROM dim_time"),
        "dim_time_sorted": _with(
            "dated_orders",
            f"""SELECT {_CALENDAR_COLUMNS}, strftime(date, '%Y-%m') AS year_month FROM (
                    SELECT DISTINCT OrderDate AS date FROM dated_orders)""",
        ),
        "dim_customer": _with("dim_customer", "SELECT * FROM dim_customer"),
        "dim_customer_s": _with("dim_customer_s", "SELECT * FROM dim_customer_s"),
        "dim_product": _with("dim_product", "SELECT * FROM dim_product"),
        "dim_product_s": _with(
            "merged_products categories",
            """SELECT * EXCLUDE (CategoryID, ProductID), ProductID AS ProductKey
               FROM merged_products LEFT JOIN categories USING (CategoryID)""",
        ),
        "dim_employee": _with("dim_employee", "SELECT * FROM dim_employee"),
        "dim_shipper": _with("dim_shipper", "SELECT * FROM dim_shipper"),
        "dim_categories": _with("categories", "SELECT * FROM categories"),
        "dim_keep_first": """
            SELECT s_nationkey, s_name, s_suppkey FROM (
                SELECT *, row_number() OVER (
                    PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS r
                FROM supplier)
            WHERE r = 1""",
        "order_detail_summary": _with(
            "database_summary",
            """SELECT * REPLACE (round(TotalLineTotal, 4) AS TotalLineTotal,
                                 round(AverageDiscount, 6) AS AverageDiscount)
               FROM database_summary""",
        ),
        "fact_sales": _with("fact", f"SELECT {_ROUNDED} FROM fact"),
        "fact_sales_s": _with("fact_s", f"SELECT {_ROUNDED} FROM fact_s"),
        "fact_sales_kept": _with(
            "fact",
            f"""SELECT f.*, CASE WHEN OrderKey < {_OFFSET} THEN o_orderstatus END AS OrderStatus
                FROM (SELECT {_ROUNDED} FROM fact) f JOIN orders ON o_orderkey = OrderKey % {_OFFSET}""",
        ),
        "star_join": _with("star", f"SELECT {_ROUNDED} FROM star"),
        "star_join_s": _with("star_s", f"SELECT {_ROUNDED} FROM star_s"),
        # The join itself, row by row, then counted per fact.
        "star_join_fanout": _with(
            "fact dim_time",
            f"""SELECT OrderKey, TimeKey, count(*) AS CalendarRows,
                       round(any_value(TotalLineTotal), 4) AS TotalLineTotal,
                       round(sum(TotalLineTotal), 4) AS FanoutLineTotal,
                       round(sum(Freight), 4) AS FanoutFreight
                FROM (SELECT *, row_number() OVER () AS fact_row FROM fact)
                     LEFT JOIN dim_time USING (TimeKey)
                GROUP BY fact_row, OrderKey, TimeKey""",
        ),
        "dim_csv_roundtrip": _with("dim_employee", "SELECT * FROM dim_employee"),
        "date_bounds": _with(
            "fact dim_time",
            """SELECT min(date) AS min_date, max(date) AS max_date
               FROM fact JOIN dim_time USING (TimeKey)""",
        ),
        "filter_domain_country": _domain("CustomerCountry"),
        "filter_domain_employee": _domain("EmployeeFullName"),
        "filter_domain_shipper": _domain("ShipperName"),
        "filter_date_range": _selected(_DATE_FILTER),
        "filter_date_range_swapped": _selected(_DATE_FILTER),
        "filter_country_subset": _selected(_COUNTRY_FILTER),
        "filter_employee_subset": _selected(
            "EmployeeFullName IN ('Supplier 000000003', 'Supplier 000000007', 'Agent 4')"
        ),
        "filter_shipper_subset": _selected("ShipperName IN ('HIGH', 'LOW')"),
        "filter_all_selected_is_noop": _selected(
            "(SELECT count(DISTINCT CustomerCountry) FROM star) = 25"
            " OR CustomerCountry IS NOT NULL"
        ),
        "kpi_unfiltered": _with(
            "star",
            _KPI.format(
                orders="(SELECT count(DISTINCT OrderKey) FROM fact)",
                customers="(SELECT count(DISTINCT CustomerKey) FROM dim_customer)",
                rows="star",
                condition="date IS NOT NULL",
            ),
        ),
        "kpi_filtered": _with(
            "star",
            _KPI.format(
                orders="count(DISTINCT OrderKey)",
                customers="count(DISTINCT CustomerKey)",
                rows="star",
                condition=_MIXED,
            ),
        ),
        "kpi_fanout": _with(
            "fact dim_time",
            _KPI.format(
                orders="count(DISTINCT OrderKey)",
                customers="count(DISTINCT CustomerKey)",
                rows="fact JOIN dim_time USING (TimeKey)",
                condition=_DATE_FILTER,
            ),
        ),
        "revenue_by_month": _with("star", _by_month("star", "date IS NOT NULL")),
        # The default range goes from midnight of the first to midnight of the last day.
        "revenue_by_month_fanout": _with(
            "fact dim_time",
            _by_month(
                "fact JOIN dim_time USING (TimeKey)",
                "date BETWEEN (SELECT date_trunc('day', min(date)) FROM dim_time)"
                " AND (SELECT date_trunc('day', max(date)) FROM dim_time)",
            ),
        ),
        "top_countries": _top("CustomerCountry"),
        "top_customers": _top("CustomerName"),
        "top_customers_filtered": _top("CustomerName", _MIXED),
        "top_employees": _top("EmployeeFullName"),
        "freight_by_shipper": _with(
            "star",
            f"""SELECT ShipperName, round({_money("Freight")}, 4) AS Freight
                FROM star WHERE ShipperName IS NOT NULL AND date IS NOT NULL
                GROUP BY ShipperName""",
        ),
        "detail_table": _detail("date IS NOT NULL"),
        "detail_export": _detail(_MIXED),
        "dq_contract": _with(_STAR_TABLES, _contract()),
        "dq_row_counts": _with(
            _STAR_TABLES + " categories",
            f"""SELECT table_name, row_count FROM ({_contract()})
                UNION ALL SELECT 'dim_categories', count(*) FROM categories""",
        ),
        "dq_merged_counts": _with(
            "merged_orders merged_details",
            """SELECT 'Orders' AS table_name, count(*) AS row_count FROM merged_orders
               UNION ALL SELECT 'Order Details', count(*) FROM merged_details""",
        ),
        "dq_null_counts": _with(
            "merged_orders sheet_employees",
            """SELECT 'missing_order_dates' AS metric, count(*) AS row_count
               FROM merged_orders WHERE OrderDate IS NULL
               UNION ALL
               SELECT 'invalid_products', count(*)
               FROM part WHERE p_type <> 'STANDARD' OR p_size > 48
               UNION ALL
               SELECT 'rejected_employee_keys', count(*)
               FROM sheet_employees WHERE EmployeeID IS NULL""",
        ),
        "dq_order_gap": _with(
            "fact merged_orders",
            """SELECT expected_orders, fact_rows, expected_orders - fact_rows AS gap FROM (
                   SELECT (SELECT count(DISTINCT OrderID) FROM merged_orders) AS expected_orders,
                          (SELECT count(*) FROM fact) AS fact_rows)""",
        ),
        "dq_preview": _with(_STAR_TABLES, _preview()),
        "dq_verdict": "SELECT true AS all_ok",
        # Spelled out: what is missing is what the query takes away.
        "dq_contract_broken": _with(
            _STAR_TABLES,
            f"""SELECT table_name, table_name <> 'dim_shipper' AS present,
                       CASE table_name WHEN 'dim_product' THEN 'UnitPrice'
                                       WHEN 'dim_shipper' THEN NULL ELSE '' END AS missing_columns,
                       CASE WHEN table_name <> 'dim_shipper' THEN row_count END AS row_count,
                       CASE table_name WHEN 'dim_product' THEN 4::int
                                       WHEN 'dim_shipper' THEN NULL ELSE column_count END AS column_count,
                       table_name NOT IN ('dim_product', 'dim_shipper') AS ok
                FROM ({_contract()})""",
        ),
        "dq_verdict_broken": "SELECT false AS all_ok",
        "strict_timestamp": """
            SELECT event_id, CASE WHEN event_type = 'click' THEN date_trunc('day', ts)
                                  WHEN event_type <> 'error' THEN ts END AS ts
            FROM events""",
        "source_fingerprint": """
            SELECT 'customer' AS table_name, sum(strlen(c_name) + 1)::BIGINT AS byte_count,
                   true AS has_files, true AS is_dated
            FROM customer
            UNION ALL SELECT 'nothing', NULL, NULL, false""",
        "x_orphan_rate": _with(
            _STAR_TABLES,
            " UNION ALL ".join(
                f"""SELECT '{t}' AS table_name, count({k}) AS facts,
                           count({k}) FILTER ({k} NOT IN (SELECT {k} FROM {t} WHERE {k} IS NOT NULL)) AS orphans
                    FROM fact"""
                for t, k in _DIMENSION_KEYS.items()
                if t != "dim_product"
            ),
        ),
        "x_dim_key_unique": _with(
            _STAR_TABLES,
            " UNION ALL ".join(
                f"""SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {k}) AS key_count
                    FROM {t}"""
                for t, k in _DIMENSION_KEYS.items()
            ),
        ),
        "x_freight_share": _with(
            "star",
            f"""SELECT ShipperName, round(Freight, 4) AS Freight, round(Freight / sum(Freight) OVER (), 4) AS Share
                FROM (SELECT ShipperName, {_money("Freight")} AS Freight
                      FROM star WHERE ShipperName IS NOT NULL AND date IS NOT NULL
                      GROUP BY ShipperName)""",
        ),
        "dq_rejects": """
            SELECT 'extract' AS source, table_name, column_name, reason, count(*) AS row_count, min(text) AS example FROM (
                SELECT 'Orders' AS table_name, 'OrderID' AS column_name, 'not a number' AS reason, 'draft' AS text
                FROM orders WHERE NOT (o_orderstatus = 'P' AND o_totalprice >= 10000)
                UNION ALL SELECT 'Orders', 'OrderDate', 'not a timestamp', 'unknown' FROM orders WHERE o_orderpriority = '1-URGENT'
                UNION ALL SELECT 'Order Details', 'Discount', 'not a number', 'none' FROM lineitem
                WHERE l_returnflag = 'R' AND l_linestatus = 'O'
                UNION ALL SELECT 'Products', 'ProductID', 'not a number', 'TBD' FROM part
                WHERE NOT (p_type = 'STANDARD' AND p_size <= 48)
                UNION ALL SELECT 'Employees', 'EmployeeID', 'not a whole number',
                    CASE s_suppkey % 4 WHEN 1 THEN s_suppkey || '.5' ELSE 'No. ' || s_suppkey END
                FROM supplier WHERE s_suppkey % 4 IN (1, 2))
            GROUP BY table_name, column_name, reason""",
        "detail_page": _detail("date IS NOT NULL") + " ORDER BY date DESC, OrderKey LIMIT 100 OFFSET 200",
        "dq_order_differences": _with(
            "merged_orders fact",
            """SELECT coalesce(e.OrderID, f.OrderKey) AS OrderID, coalesce(expected, 0) AS expected,
                      coalesce(present, 0) AS present
               FROM (SELECT OrderID, count(DISTINCT OrderID) AS expected FROM merged_orders
                     WHERE OrderID IS NOT NULL GROUP BY OrderID) e
               FULL JOIN (SELECT OrderKey, count(*) AS present FROM fact GROUP BY OrderKey) f ON e.OrderID = f.OrderKey
               WHERE coalesce(expected, 0) <> coalesce(present, 0)""",
        ),
        "x_category_revenue": _with(
            "merged_details dim_product",
            f"""SELECT CategoryName, round({_money("LineTotal")}, 4) AS CA FROM (
                    SELECT coalesce(CategoryName, 'Unknown') AS CategoryName,
                           coalesce(UnitPrice, 0) * coalesce(Quantity, 0) * (1 - coalesce(Discount, 0)) AS LineTotal
                    FROM merged_details LEFT JOIN (SELECT ProductKey, CategoryName FROM dim_product)
                         ON ProductID = ProductKey)
                GROUP BY CategoryName""",
        ),
    }
