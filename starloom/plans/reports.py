"""Answers over the star: filters, key figures, breakdowns, the detail listing.

Every breakdown adds up the fact per key before it meets a dimension, so a hot customer, day or
shipper is reduced inside the scan's own tasks and the joins see one row per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.functions import clean
from starloom.operators.aggregate import exact_sum, sum_by, top
from starloom.operators.join import lookup
from starloom.plans.star_schema import Star, day_calendar
from starloom.sources.layout import FACT_PARTITION

# Attribute a list filter works on -> the dimension holding it and the fact's key to it.
ATTRIBUTES = {
    "CustomerCountry": ("dim_customer", "CustomerKey"),
    "CustomerName": ("dim_customer", "CustomerKey"),
    "EmployeeFullName": ("dim_employee", "EmployeeKey"),
    "ShipperName": ("dim_shipper", "ShipperKey"),
}
# Attributes that selections list, and the name of the calendar among a view's dimensions.
LISTS = ("CustomerCountry", "EmployeeFullName", "ShipperName")
_DAY = "dim_day"


@dataclass(frozen=True)
class Selection:
    """What a user picked.

    ``date_range`` is None for the full range, two days in either order, or one day while the
    second is still to be picked, which filters nothing. An empty list filters nothing.
    """

    date_range: tuple[dt.date, ...] | None = None
    countries: Sequence[str] = ()
    employees: Sequence[str] = ()
    shippers: Sequence[str] = ()

    def lists(self) -> dict[str, list[str]]:
        return {
            "CustomerCountry": list(self.countries),
            "EmployeeFullName": list(self.employees),
            "ShipperName": list(self.shippers),
        }


@dataclass(frozen=True)
class Members:
    """Rows of a dimension that a selection leaves, its key, and if it was just grouped by it."""

    rows: DataFrame
    key: str
    grouped: bool


@dataclass(frozen=True)
class View:
    """The facts a selection leaves, and whether it differs from the default.

    ``dated`` are the facts within the dates; ``members`` the keys that further narrow them,
    by the dimension that they belong to.
    """

    star: Star
    dated: DataFrame
    members: dict[str, Members]
    active: bool
    calendar: str = "day"

    def narrow(self, facts: DataFrame) -> DataFrame:
        for m in self.members.values():
            facts = lookup(facts, m.rows.select(m.key), m.key, "left_semi", m.grouped)
        return facts

    @property
    def fact(self) -> DataFrame:
        return self.narrow(self.dated)


# Star join ------------------------------------------------------------------------------------


# Column names that dimensions have in the star join where two would clash.
_RENAMES = {
    "dim_customer": {"Phone": "CustomerPhone"},
    "dim_shipper": {"Phone": "ShipperPhone"},
}
_JOINED = {"dim_customer": "CustomerKey", "dim_employee": "EmployeeKey", "dim_shipper": "ShipperKey"}


def _with_measures(fact: DataFrame) -> DataFrame:
    """Measures as numbers, zero where missing; whole-number measures stay whole."""

    types = {field.name: field.dataType for field in fact.schema}

    def measure(name: str) -> Column:
        dtype = types[name]
        if isinstance(dtype, T.IntegralType):
            return F.coalesce(F.col(name), F.lit(0).cast(dtype))
        is_text = isinstance(dtype, T.StringType)
        return clean.or_zero(clean.number(F.col(name)) if is_text else F.col(name).cast("double"))

    return fact.withColumns({c: measure(c) for c in S.MEASURES if c in types})


def _days(star: Star) -> tuple[DataFrame, bool]:
    """The calendar at day grain, one row per ``TimeKey``, and whether it had to be grouped."""
    if star.dim_day is not None:
        return star.dim_day, False
    return day_calendar(star.dim_time), True


def _join_days(star: Star, df: DataFrame, how: str, *columns: str) -> DataFrame:
    days, grouped = _days(star)
    if columns:
        days = days.select("TimeKey", *columns)
    return lookup(df, days, "TimeKey", how, grouped)


def _join_dimensions(
    star: Star, fact: DataFrame, members: Mapping[str, Members] | None = None
) -> DataFrame:
    """Facts with their dimensions; a dimension with ``members`` is joined once, to filter too.

    Days that don't filter come last: a dimension too large to broadcast shuffles the facts, which
    are narrow until then.
    """
    members = members or {}
    joined = own = fact.drop(FACT_PARTITION)
    if _DAY in members:
        joined = _join_days(star, joined, "inner")
    for name, key in _JOINED.items():
        rows = members[name].rows if name in members else getattr(star, name)
        rows = rows.withColumnsRenamed(_RENAMES.get(name, {}))
        joined = lookup(joined, rows, key, "inner" if name in members else "left")
    if _DAY in members:
        return joined
    dims = joined.columns[len(own.columns) :]
    joined = _join_days(star, joined, "left")
    days = joined.columns[len(own.columns) + len(dims) :]
    return joined.select(*own.columns, *days, *dims)


def star_join(star: Star) -> DataFrame:
    """Every fact once, with its calendar day, customer, employee and shipper where known."""
    return _join_dimensions(star, _with_measures(star.fact_sales))


def calendar_rows(star: Star, days: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Rows the calendar holds per day key, within midnight of the first and the last day."""
    calendar = star.dim_time
    if days is not None:
        calendar = calendar.where(F.col("date").between(_midnight(days[0]), _midnight(days[1])))
    return calendar.groupBy("TimeKey").agg(F.count(F.lit(1)).alias("CalendarRows"))


def star_join_fanout(star: Star) -> DataFrame:
    """The join on a calendar that holds several timestamps per day, as counts.

    Joined row by row, every fact would appear once per timestamp of its day, a product that
    grows with the square of a day's orders. ``CalendarRows`` says how often instead, and
    ``FanoutLineTotal`` and ``FanoutFreight`` are what those copies add up to.
    """
    joined = lookup(
        _with_measures(star.fact_sales), calendar_rows(star), "TimeKey", right_grouped=True
    )
    copies = F.coalesce("CalendarRows", F.lit(1).cast("bigint"))
    return joined.select(
        "OrderKey",
        "TimeKey",
        copies.alias("CalendarRows"),
        "TotalLineTotal",
        (F.col("TotalLineTotal") * copies).alias("FanoutLineTotal"),
        (F.col("Freight") * copies).alias("FanoutFreight"),
    )


# Filters --------------------------------------------------------------------------------------


def _midnight(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def _day(value: dt.date | dt.datetime | str) -> dt.date:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return value.date() if isinstance(value, dt.datetime) else value


def _key_of(day: dt.date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _bounds(star: Star, calendar: DataFrame) -> DataFrame:
    if star.known is not None:
        date = F.to_timestamp_ntz("value")
        bounds = star.known.where(F.col("attribute").isin("min_date", "max_date"))
        return bounds.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))
    used = star.fact_sales.select("TimeKey").distinct()
    dates = lookup(calendar.select("TimeKey", "date"), used, "TimeKey", "left_semi")
    return dates.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def date_bounds(star: Star) -> DataFrame:
    """First and last calendar timestamp that a fact refers to."""
    return _bounds(star, star.dim_time)


def filter_domain(star: Star, attribute: str) -> DataFrame:
    """Values of an attribute that occur among the facts, sorted."""
    if star.known is not None and attribute in LISTS:
        values = star.known.where(F.col("attribute") == attribute)
        return values.select(F.col("value").alias(attribute)).orderBy(attribute)
    dimension, key = ATTRIBUTES[attribute]
    used = star.fact_sales.select(key).distinct()
    return (
        lookup(getattr(star, dimension).select(key, attribute), used, key, "left_semi")
        .select(attribute)
        .where(F.col(attribute).isNotNull())
        .distinct()
        .orderBy(attribute)
    )


def known_values(star: Star) -> DataFrame:
    """``attribute, value``: what selections are checked against, so that they need no fact pass.

    The values of each list that occur among the facts, the first and last date, and whether the
    calendar lacks the day of some fact.
    """

    def row(attribute: str, df: DataFrame, value: Column) -> DataFrame:
        return df.select(F.lit(attribute).alias("attribute"), value.cast("string").alias("value"))

    bounds = date_bounds(star)
    lost = _join_days(star, star.fact_sales.select("TimeKey"), "left_anti").limit(1).agg(F.count(F.lit(1)).alias("n"))
    parts = [row(a, filter_domain(star, a), F.col(a)) for a in LISTS]
    parts += [row(c, bounds, F.col(c)) for c in ("min_date", "max_date")]
    return reduce(DataFrame.unionByName, [*parts, row("lost_days", lost, F.col("n"))])


def _is_subset(star: Star, attribute: str, values: Sequence[str]) -> bool:
    """Whether the picked values differ from all values that occur among the facts."""
    if not values:
        return False
    picked = F.count_if(F.col(attribute).isin(*values))
    known, among = filter_domain(star, attribute).agg(F.count(F.lit(1)), picked).first()
    return among < known or known != len(set(values))


def select_view(star: Star, selection: Selection = Selection(), calendar: str = "day") -> View:
    """Apply a selection to the facts.

    ``calendar="day"`` counts every fact once. ``"timestamp"`` reproduces the join on a calendar
    with several timestamps per day: money is multiplied by the timestamps of the fact's day
    that lie between midnight of the first and midnight of the last day.
    """
    if calendar not in ("day", "timestamp"):
        raise ValueError(f"unknown calendar grain {calendar}")
    fact, active = _with_measures(star.fact_sales), False

    picked = selection.date_range
    bounds = None
    if picked is not None or calendar == "timestamp":
        first, last = _bounds(star, _days(star)[0]).first()
        bounds = None if first is None else (first.date(), last.date())
    days = bounds
    if picked is not None and len(picked) == 2:
        days = tuple(sorted((_day(picked[0]), _day(picked[1]))))
        active = days != bounds
    dated = picked is None or len(picked) == 2

    if dated and days is not None:
        # The partition column has to be named for Spark to skip other years' folders.
        if FACT_PARTITION in fact.columns:
            fact = fact.where(F.col(FACT_PARTITION).between(days[0].year, days[1].year))
        fact = fact.where(F.col("TimeKey").between(_key_of(days[0]), _key_of(days[1])))
    members = {}
    if calendar == "timestamp":
        rows = calendar_rows(star, days if dated else None)
        fact = lookup(fact, rows, "TimeKey", "inner" if dated else "left", right_grouped=True)
        copies = F.coalesce("CalendarRows", F.lit(1).cast("bigint"))
        fact = fact.withColumns(
            {c: F.col(c) * copies for c in ("TotalLineTotal", "Freight")}
        ).drop("CalendarRows")
    elif dated:
        known, grouped = _days(star)
        members[_DAY] = Members(known, "TimeKey", grouped)

    for attribute, values in selection.lists().items():
        if _is_subset(star, attribute, values):
            dimension, key = ATTRIBUTES[attribute]
            rows = getattr(star, dimension).where(F.col(attribute).isin(*values))
            members[dimension] = Members(rows, key, False)
            active = True
    return View(star, fact, members, active, calendar)


def selected_rows(view: View) -> DataFrame:
    """The star join of the selected facts, each listed once."""
    return _listed(view, view.dated)


def _listed(view: View, facts: DataFrame) -> DataFrame:
    if view.calendar != "day":
        raise ValueError("money in this view is multiplied already; list rows from a day view")
    return _join_dimensions(view.star, facts, view.members)


# Key figures ----------------------------------------------------------------------------------


def _holds_all_facts(view: View) -> bool:
    """Whether the default selection leaves no fact out, so that its orders are all orders.

    Reads one column of the facts, where counting all orders once more would shuffle them.
    """
    if view.calendar != "day":
        return False
    if view.star.known is not None:
        lost = view.star.known.where("attribute = 'lost_days' and value <> '0'")
        return lost.isEmpty()
    days = view.star.fact_sales.select("TimeKey")
    return _join_days(view.star, days, "left_anti").isEmpty()


def kpis(view: View) -> DataFrame:
    """Revenue, orders, customers and average basket, in one row.

    Without an active filter, orders are all orders and customers all known customers, buyers or
    not; with one, both are counted among the selected facts. The basket always divides by the
    selected orders.
    """
    figures = view.fact.agg(
        exact_sum("TotalLineTotal").cast("double").alias("revenue"),
        F.count_distinct("OrderKey").alias("selected_orders"),
        F.count_distinct("CustomerKey").alias("selected_customers"),
    )
    return _key_figures(view, figures)


def _key_figures(view: View, figures: DataFrame) -> DataFrame:
    """Key figures from ``revenue, selected_orders, selected_customers`` of a view."""
    orders, customers = F.col("selected_orders"), F.col("selected_customers")
    if not view.active:
        star = view.star
        if not _holds_all_facts(view):
            orders = star.fact_sales.agg(F.count_distinct("OrderKey")).scalar()
        customers = star.dim_customer.agg(F.count_distinct("CustomerKey")).scalar()
    basket = F.try_divide("revenue", "selected_orders")
    return figures.select(
        "revenue",
        orders.alias("orders"),
        customers.alias("customers"),
        F.coalesce(basket, F.lit(0.0).cast("double")).alias("average_basket"),
    )


# Breakdowns -----------------------------------------------------------------------------------


def revenue_by_month(view: View) -> DataFrame:
    """Revenue per calendar month, oldest first."""
    by_day = sum_by(view.fact, "TimeKey", "TotalLineTotal", "CA")
    return (
        _join_days(view.star, by_day, "inner", "year", "month")
        .groupBy("year", "month")
        .agg(F.sum("CA").cast("double").alias("CA"))
        .withColumn("Mois", clean.first_of_month(F.col("year"), F.col("month")))
        .orderBy("Mois")
    )


def _by_attribute(view: View, attribute: str, measure: str, alias: str) -> DataFrame:
    """Exact sum per value of a dimension attribute, facts without one left out."""
    dimension, key = ATTRIBUTES[attribute]
    by_key = sum_by(view.fact, key, measure, alias)
    named = lookup(by_key, getattr(view.star, dimension).select(key, attribute), key, "inner")
    return (
        named.where(F.col(attribute).isNotNull())
        .groupBy(attribute)
        .agg(F.sum(alias).cast("double").alias(alias))
    )


def top_countries(view: View, n: int = 10) -> DataFrame:
    return top(_by_attribute(view, "CustomerCountry", "TotalLineTotal", "CA"), "CA", "CustomerCountry", n)


def top_customers(view: View, n: int = 10) -> DataFrame:
    """By customer name: two customers of one name count as one."""
    return top(_by_attribute(view, "CustomerName", "TotalLineTotal", "CA"), "CA", "CustomerName", n)


def top_employees(view: View, n: int = 10) -> DataFrame:
    return top(_by_attribute(view, "EmployeeFullName", "TotalLineTotal", "CA"), "CA", "EmployeeFullName", n)


def freight_by_shipper(view: View) -> DataFrame:
    """Freight per shipper name, largest first."""
    freight = _by_attribute(view, "ShipperName", "Freight", "Freight")
    return freight.orderBy(F.col("Freight").desc(), "ShipperName")


def with_share(breakdown: DataFrame, measure: str) -> DataFrame:
    """A breakdown's measure also as a share of its total."""
    total = breakdown.agg(F.sum(measure)).scalar()
    return breakdown.withColumn("Share", F.try_divide(measure, total))


def revenue_by_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per category of lines with a ``LineTotal``; products that are not known are one."""
    by_product = sum_by(lines, "ProductID", "LineTotal", "CA").withColumnRenamed("ProductID", "ProductKey")
    named = lookup(by_product, products.select("ProductKey", "CategoryName"), "ProductKey")
    category = F.coalesce("CategoryName", F.lit(S.DEFAULT_CATEGORY)).alias("CategoryName")
    return named.groupBy(category).agg(F.sum("CA").cast("double").alias("CA"))


# All at once ----------------------------------------------------------------------------------

_KEYS = ("TimeKey", "CustomerKey", "EmployeeKey", "ShipperKey")
# Tiles of the answer set: the attribute that names their rows, the measure, and how many are shown.
TILES = {
    "country": ("CustomerCountry", "revenue", 10),
    "customer": ("CustomerName", "revenue", 10),
    "employee": ("EmployeeFullName", "revenue", 10),
    "shipper": ("ShipperName", "freight", None),
}


def partial_answers(view: View) -> DataFrame:
    """``part``, the keys, ``revenue, freight, orders``: what all tiles are made of, in one pass.

    Grouping sets over the view's facts give exact sums per day, customer, employee and shipper.
    ``part`` names the key that a row is for. Orders are bitmaps: order numbers that differ in the
    last six bits only share a row (``Word``), with a bit for each in ``orders``, so that counting
    bits counts distinct orders exactly, from a sixty-fourth of the rows where numbers are dense.
    Buffers are of fixed width, so a hash aggregation takes them all. Two such tables, say of two
    years, become one by adding sums up and joining bits by ``bit_or``.
    """
    bit = F.expr("shiftleft(1L, cast(OrderKey & 63 AS int))")
    facts = view.fact.select(*_KEYS, F.shiftright("OrderKey", 6).alias("Word"), bit.alias("bit"), "TotalLineTotal", "Freight")
    keys = [F.col(k) for k in (*_KEYS, "Word")]
    grouped = facts.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("grouping"),
        exact_sum("TotalLineTotal").alias("revenue"),
        exact_sum("Freight").alias("freight"),
        F.bit_or("bit").alias("bits"),
    )
    # The id of a grouping set has a bit for every key that is not in it, the last key's lowest.
    names = {(1 << len(keys)) - 1 - (1 << n): name for n, name in enumerate((*_KEYS, "Word")[::-1])}
    part = F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.col("grouping").cast("int"))
    orders = F.when(part == "Word", F.col("bits")).alias("orders")
    return grouped.select(part.alias("part"), *keys, "revenue", "freight", orders)


def merged_answers(*parts: DataFrame) -> DataFrame:
    """Partial answers of facts that are taken together."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("part", *_KEYS, "Word").agg(
        F.sum("revenue").cast("decimal(30,6)").alias("revenue"),
        F.sum("freight").cast("decimal(30,6)").alias("freight"),
        F.bit_or("orders").alias("orders"),
    )


def answers_from(view: View, partial: DataFrame) -> DataFrame:
    """``tile, name, value`` of all tiles, from partial answers that were stored."""

    def part(key: str) -> DataFrame:
        return partial.where(F.col("part") == key)

    def tile(name: str, rows: DataFrame, label: Column, value: Column) -> DataFrame:
        return rows.select(F.lit(name).alias("tile"), label.cast("string").alias("name"), value.cast("double").alias("value"))

    by_day = part("TimeKey").where("TimeKey is not null")
    months = _join_days(view.star, by_day, "inner", "year", "month").groupBy("year", "month").agg(F.sum("revenue").alias("CA"))
    tiles = [tile("month", months, clean.first_of_month(F.col("year"), F.col("month")), F.col("CA"))]
    for name, (attribute, measure, shown) in TILES.items():
        dimension, key = ATTRIBUTES[attribute]
        rows = lookup(part(key), getattr(view.star, dimension).select(key, attribute), key, "inner")
        rows = rows.where(F.col(attribute).isNotNull()).groupBy(attribute).agg(F.sum(measure).cast("double").alias("value"))
        tiles.append(tile(name, top(rows, "value", attribute, shown) if shown else rows, F.col(attribute), F.col("value")))

    # Every fact is in one row of each part, so any part has the whole revenue.
    total = F.coalesce(F.sum(F.when(F.col("part") == "TimeKey", F.col("revenue"))).cast("double"), F.lit(0.0).cast("double"))
    orders = F.coalesce(F.sum(F.bit_count("orders")), F.lit(0).cast("bigint"))
    customers = F.count(F.when(F.col("part") == "CustomerKey", F.col("CustomerKey")))
    figures = partial.agg(total.alias("revenue"), orders.alias("selected_orders"), customers.alias("selected_customers"))
    totals = _key_figures(view, figures)
    pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in totals.columns))
    totals = totals.select(F.explode(pairs).alias("x"))
    return reduce(DataFrame.unionByName, [*tiles, tile("total", totals, F.col("x.name"), F.col("x.value"))])


# Detail ---------------------------------------------------------------------------------------


def detail_table(view: View) -> DataFrame:
    """Every selected fact with its display columns, latest day first.

    Days are too coarse to sort by alone: a busy day, or copies of one order, would end up in
    one task. The order number and a running number break such ranges up. The number is given
    where the facts are scanned, so that a task run again gives the same ones.
    """
    rows = _listed(view, view.dated.withColumn("_copy", F.monotonically_increasing_id()))
    present = set(rows.columns)
    columns = [c for c in S.DETAIL_COLUMNS if c in present]
    order = [F.col("date").desc_nulls_last(), F.col("OrderKey"), F.col("_copy")]
    return rows.select(*columns, "_copy").orderBy(*order).drop("_copy")
