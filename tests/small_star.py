"""A hand-made star: repeated days, unknown keys, shared names."""

from __future__ import annotations

import datetime as dt

from starloom import schemas as S
from starloom.plans.star_schema import Star

D = dt.datetime

CALENDAR = [
    D(1996, 7, 4),
    D(1996, 7, 4, 17, 3, 55),
    D(1996, 7, 4, 17, 26, 53),
    D(1996, 8, 1),
    D(1997, 1, 15),
    D(1997, 1, 16, 9, 0, 0),
]
CUSTOMERS = [
    ("A", "Alpha", "Berlin", "Germany", "1"),
    ("B", "Beta", "Paris", "France", "2"),
    ("C", "Beta", "Lyon", "France", "3"),
    ("D", "Delta", "Rome", None, "4"),
    ("E", "Never bought", "Oslo", "Norway", "5"),
]
EMPLOYEES = [
    (1, "Ann Lee", "Ann", "Lee", "Rep", "X", "UK"),
    (2, None, "Bob", None, "Rep", "Y", "UK"),
]
SHIPPERS = [(1, "Rapid", "9"), (2, "Unified", "8")]
# OrderKey, TimeKey, CustomerKey, EmployeeKey, ShipperKey, total, freight
FACTS = [
    (1, 19960704, "A", 1, 1, 100.0, 1.0),
    (2, 19960704, "B", 2, 2, 200.5, 2.0),
    (3, 19960801, "C", 1, 1, 50.25, 3.0),
    (4, 19970115, "D", 1, None, 10.0, 4.0),
    (5, 19970115, "unknown", None, 2, 5.0, 5.0),
    (6, 19970116, None, 1, 1, 7.0, 6.0),
    (6, 19970116, "A", 1, 1, 7.0, 6.0),
    (7, 20200101, "A", 1, 1, 1000.0, 7.0),
]


def key(ts: dt.datetime) -> int:
    return ts.year * 10000 + ts.month * 100 + ts.day


def small_star(spark) -> Star:
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    facts = [
        (o, t, c, e, s, 2, 3.0, 0.1, total, D(1996, 1, 1), freight)
        for o, t, c, e, s, total, freight in FACTS
    ]
    return Star(
        dim_time=frame([(key(d), d, d.year, d.month, d.day) for d in CALENDAR], S.DIM_TIME),
        dim_customer=frame(CUSTOMERS, S.DIM_CUSTOMER),
        dim_product=frame([(1, "Tea", 18.0, "Drinks", False)], S.DIM_PRODUCT),
        dim_employee=frame(EMPLOYEES, S.DIM_EMPLOYEE),
        dim_shipper=frame(SHIPPERS, S.DIM_SHIPPER),
        dim_categories=frame([(1, "Drinks")], S.DIM_CATEGORIES),
        fact_sales=frame(facts, S.FACT_SALES),
    )
