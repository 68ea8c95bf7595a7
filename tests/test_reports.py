"""Reports against plain loops over the hand-made star."""

import datetime as dt
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from small_star import CALENDAR, CUSTOMERS, EMPLOYEES, FACTS, SHIPPERS, key, small_star

from starloom.plans import reports
from starloom.plans.reports import Selection, select_view

COUNTRY = {c[0]: c[3] for c in CUSTOMERS}
NAME = {c[0]: c[1] for c in CUSTOMERS}
FULL_NAME = {e[0]: e[1] for e in EMPLOYEES}
SHIPPER = {s[0]: s[1] for s in SHIPPERS}
KNOWN_DAYS = {key(d) for d in CALENDAR}
ALL_KNOWN = [f for f in FACTS if f[1] in KNOWN_DAYS]


@pytest.fixture(scope="module")
def star(spark):
    return small_star(spark)


def orders(view) -> list[int]:
    return sorted(r.OrderKey for r in reports.selected_rows(view).collect())


def pairs(df) -> list[tuple]:
    return [tuple(r) for r in df.collect()]


def test_star_join_keeps_every_fact_once(star):
    rows = reports.star_join(star).collect()
    assert len(rows) == len(FACTS)
    assert {"CustomerPhone", "ShipperPhone"} <= set(rows[0].asDict())
    unknown = next(r for r in rows if r.OrderKey == 5)
    assert (unknown.CustomerName, unknown.EmployeeFullName, unknown.ShipperName) == (
        None,
        None,
        "Unified",
    )
    undated = next(r for r in rows if r.OrderKey == 7)
    assert (undated.date, undated.year) == (None, None)


def test_star_join_shuffles_narrow_facts(spark, star):
    """A customer table too large to broadcast meets the facts before their days are joined."""
    joined = reports.star_join(star)
    names = star.fact_sales.columns
    assert joined.columns[: len(names) + 5] == [*names, "date", "year", "month", "day", "CustomerName"]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if "Join Left" in line]
    assert "TimeKey" in conditions[0] and "CustomerKey" in conditions[-1]


def test_fanout_counts_equal_the_joined_rows(star):
    joined = defaultdict(list)
    for f in FACTS:
        copies = [d for d in CALENDAR if key(d) == f[1]] or [None]
        joined[f[0]] += [f[5]] * len(copies)
    found = defaultdict(float)
    rows = defaultdict(int)
    for r in reports.star_join_fanout(star).collect():
        found[r.OrderKey] += r.FanoutLineTotal
        rows[r.OrderKey] += r.CalendarRows
    assert found == {o: sum(v) for o, v in joined.items()}
    assert rows == {o: len(v) for o, v in joined.items()}


def test_default_leaves_out_unknown_days_only(star):
    view = select_view(star)
    assert orders(view) == sorted(f[0] for f in ALL_KNOWN)
    assert not view.active


@pytest.mark.parametrize(
    "picked",
    [
        (dt.date(1996, 7, 4), dt.date(1996, 8, 1)),
        (dt.date(1996, 8, 1), dt.date(1996, 7, 4)),
        ("1996-07-04", dt.datetime(1996, 8, 1, 12)),
    ],
)
def test_dates_are_inclusive_and_swap(star, picked):
    view = select_view(star, Selection(date_range=picked))
    assert orders(view) == [1, 2, 3]
    assert view.active


def test_the_full_range_is_no_filter(star):
    view = select_view(star, Selection(date_range=("1996-07-04", "1997-01-16")))
    assert not view.active
    assert orders(view) == sorted(f[0] for f in ALL_KNOWN)


def test_a_half_picked_range_filters_nothing(star):
    view = select_view(star, Selection(date_range=("1996-07-04",)))
    assert orders(view) == sorted(f[0] for f in FACTS)
    assert not view.active


def test_lists(star):
    def selected(**kw):
        view = select_view(star, Selection(**kw))
        return orders(view), view.active

    everything = sorted(f[0] for f in ALL_KNOWN)
    assert selected(countries=[]) == (everything, False)
    # Norway has no facts, so it is no choice; both others are all choices.
    assert selected(countries=["Germany", "France"]) == (everything, False)
    assert selected(countries=["France"]) == ([2, 3], True)
    assert selected(countries=["Germany", "France", "Norway"]) == ([1, 2, 3, 6], True)
    assert selected(employees=["Ann Lee"]) == (everything, False)
    assert selected(shippers=["Unified"]) == ([2, 5], True)
    assert selected(countries=["France"], shippers=["Rapid"]) == ([3], True)


def test_domains_and_bounds(star):
    assert pairs(reports.filter_domain(star, "CustomerCountry")) == [("France",), ("Germany",)]
    assert pairs(reports.filter_domain(star, "EmployeeFullName")) == [("Ann Lee",)]
    assert pairs(reports.filter_domain(star, "ShipperName")) == [("Rapid",), ("Unified",)]
    assert pairs(reports.date_bounds(star)) == [
        (dt.datetime(1996, 7, 4), dt.datetime(1997, 1, 16, 9))
    ]


def test_kpis(star):
    revenue = sum(f[5] for f in ALL_KNOWN)
    assert pairs(reports.kpis(select_view(star))) == [
        (revenue, 7, len(CUSTOMERS), pytest.approx(revenue / 6))
    ]
    france = select_view(star, Selection(countries=["France"]))
    assert pairs(reports.kpis(france)) == [(250.75, 2, 2, 250.75 / 2)]
    nothing = select_view(star, Selection(countries=["Norway"]))
    assert pairs(reports.kpis(nothing)) == [(0.0, 0, 0, 0.0)]


def test_kpis_when_every_day_is_known(star):
    known = replace(star, fact_sales=star.fact_sales.where("OrderKey <> 7"))
    revenue = sum(f[5] for f in ALL_KNOWN)
    assert pairs(reports.kpis(select_view(known))) == [
        (revenue, 6, len(CUSTOMERS), pytest.approx(revenue / 6))
    ]


def test_kpis_on_a_calendar_with_several_timestamps_per_day(star):
    # By default the range ends at midnight of the last day, when order 6's day has no row yet.
    view = select_view(star, calendar="timestamp")
    expected = 3 * 300.5 + 50.25 + 15.0
    assert pairs(reports.kpis(view)) == [(expected, 7, 5, pytest.approx(expected / 5))]
    assert [r[2] for r in pairs(reports.revenue_by_month(view))] == [901.5, 50.25, 15.0]
    # A range ending on the busy day itself keeps the midnight copy only.
    one_day = Selection(date_range=("1996-07-04", "1996-07-04"))
    view = select_view(star, one_day, calendar="timestamp")
    assert pairs(reports.kpis(view)) == [(300.5, 2, 2, 150.25)]
    with pytest.raises(ValueError, match="day view"):
        reports.detail_table(view)
    with pytest.raises(ValueError, match="week"):
        select_view(star, calendar="week")


def test_revenue_by_month(star):
    assert pairs(reports.revenue_by_month(select_view(star))) == [
        (1996, 7, 300.5, dt.date(1996, 7, 1)),
        (1996, 8, 50.25, dt.date(1996, 8, 1)),
        (1997, 1, 29.0, dt.date(1997, 1, 1)),
    ]


def sums(attribute: dict, column: int, measure: int) -> dict:
    out = defaultdict(float)
    for f in ALL_KNOWN:
        name = attribute.get(f[column])
        if name is not None:
            out[name] += f[measure]
    return out


def test_rankings(star):
    view = select_view(star)
    countries = sums(COUNTRY, 2, 5)
    assert pairs(reports.top_countries(view)) == sorted(countries.items(), key=lambda p: p[1])
    customers = sums(NAME, 2, 5)
    assert customers["Beta"] == 250.75
    assert pairs(reports.top_customers(view)) == sorted(customers.items(), key=lambda p: p[1])
    assert pairs(reports.top_customers(view, n=1)) == [("Beta", 250.75)]
    assert pairs(reports.top_employees(view)) == list(sums(FULL_NAME, 3, 5).items())
    freight = sums(SHIPPER, 4, 6)
    assert pairs(reports.freight_by_shipper(view)) == sorted(
        freight.items(), key=lambda p: -p[1]
    )


def test_ties_go_by_name(spark, star):
    from starloom.operators.aggregate import top

    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "name string, x double")
    assert pairs(top(df, "x", "name", 2)) == [("a", 1.0), ("c", 2.0)]


def test_detail_is_sorted_and_whole(star):
    view = select_view(star, Selection(date_range=("1996-07-04",)))
    rows = reports.detail_table(view).collect()
    assert rows[0].asDict().keys() == dict.fromkeys(reports.S.DETAIL_COLUMNS).keys()
    dates = [r.date for r in rows]
    assert dates[-1] is None and len(rows) == len(FACTS)
    assert dates[:-1] == sorted(dates[:-1], reverse=True)


def test_detail_shows_the_columns_there_are(star):
    slim = replace(star, fact_sales=star.fact_sales.drop("Freight"))
    columns = reports.detail_table(select_view(slim)).columns
    assert "Freight" not in columns and "TotalLineTotal" in columns


def test_exact_sum_does_not_depend_on_order(spark):
    from starloom.operators.aggregate import exact_sum

    values = [0.1, 0.2, 0.3, -0.35, 1e9 + 0.0001, 123456.789012] * 50
    expected = 50 * (0.25 + 1e9 + 0.0001 + 123456.789012)
    found = set()
    for rows in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in rows], "v double").repartition(7)
        found.add(df.agg(exact_sum("v").cast("string")).first()[0])
    assert len(found) == 1
    assert float(found.pop()) == pytest.approx(expected, abs=1e-4)
    empty = spark.createDataFrame([], "v double").agg(exact_sum("v").cast("double")).first()
    assert empty[0] == 0.0


def test_copies_of_one_order_do_not_end_up_in_one_task(spark, star, tmp_path):
    """A third of the facts are the same order; the sort spreads them nevertheless."""
    one = star.fact_sales.where("OrderKey = 1").drop("OrderKey")
    many = one.selectExpr("*", "explode(sequence(0L, 29999L)) as id").repartition(6)
    facts = many.selectExpr("if(id % 3 = 0, 1, id) as OrderKey", "* except (id)")
    facts.write.parquet(str(tmp_path / "fact"))
    facts = spark.read.parquet(str(tmp_path / "fact"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = reports.detail_table(select_view(replace(star, fact_sales=facts)))
        parts = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in parts) == 30000
    assert max(r["count"] for r in parts) < 30000 / 3


def test_answers_from_one_pass_equal_the_single_reports(star, tmp_path):
    for n, selection in enumerate((Selection(), Selection(countries=["France"]), Selection(date_range=("1996-08-01", "1997-01-15")))):
        view = select_view(star, selection)
        path = f"{tmp_path}/{n}"
        reports.partial_answers(view).write.parquet(path)
        partial = star.fact_sales.sparkSession.read.parquet(path)
        got = {(r.tile, r.name): r.value for r in reports.answers_from(view, partial).collect()}
        expected = {("month", str(r.Mois)): r.CA for r in reports.revenue_by_month(view).collect()}
        expected |= {("country", r[0]): r.CA for r in reports.top_countries(view).collect()}
        expected |= {("customer", r[0]): r.CA for r in reports.top_customers(view).collect()}
        expected |= {("employee", r[0]): r.CA for r in reports.top_employees(view).collect()}
        expected |= {("shipper", r[0]): r.Freight for r in reports.freight_by_shipper(view).collect()}
        figures = reports.kpis(view).first().asDict()
        expected |= {("total", name): float(value) for name, value in figures.items()}
        assert got == expected
        plan = reports.partial_answers(view)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("TotalLineTotal#") and plan.count("Expand") == 1


def test_partial_answers_of_two_parts_become_one(star):
    whole = select_view(star)
    halves = [replace(whole, dated=whole.dated.where(f"OrderKey % 2 = {n}")) for n in (0, 1)]
    merged = reports.merged_answers(*map(reports.partial_answers, halves), reports.partial_answers(whole).limit(0))
    key = lambda r: tuple(map(str, r))
    columns = reports.partial_answers(whole).columns
    assert sorted(merged.select(columns).collect(), key=key) == sorted(reports.partial_answers(whole).collect(), key=key)
    both = reports.merged_answers(reports.partial_answers(whole), reports.partial_answers(whole))
    bits = lambda df: df.agg(F.sum(F.bit_count("orders"))).first()[0]
    assert bits(both) == bits(reports.partial_answers(whole))  # distinct orders stay distinct
