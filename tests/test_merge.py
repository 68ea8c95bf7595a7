import pytest

from starloom import schemas as S
from starloom.operators import merge
from starloom.operators.merge import (
    keep_first,
    merge_sources,
    namespace_ids,
    require_below,
    union_sources,
)
from starloom.plans.star_schema import merge_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_wins_and_null_keys_go(spark):
    extract = spark.createDataFrame([("1", "sheet"), (None, "lost")], "CustomerID string, City string")
    sql = spark.createDataFrame([(1, "db", "DE"), (2, "db", "FR")], "CustomerID int, City string, Country string")
    merged = merge_table(S.CUSTOMERS, {"Customers": extract}, {"Customers": sql})
    assert sorted(merged.select("CustomerID", "City", "Country").collect()) == [
        ("1", "sheet", None),
        ("2", "db", "FR"),
    ]


def test_single_and_no_source(spark):
    only = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    assert union_sources(None, only) is only
    assert merge_sources(only, None, ["k"]).collect() == [(1, "a")]
    assert merge_sources(None, None, ["k"]) is None
    with pytest.raises(ValueError, match="Customers"):
        merge_table(S.CUSTOMERS, {}, {"Customers": None})


def test_without_dedupe_every_row_stays(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 5)], "k int, w int")
    merged = merge_sources(a, b, ["k"], dedupe=False)
    assert merged.columns == ["k", "v", "w"]
    assert merged.count() == 3


def test_keep_first_reduces_before_the_shuffle(spark):
    df = spark.range(0, 9000, 1, 6).selectExpr("id % 3 as k", "id as v")
    first = keep_first(df, ["k"])
    assert sorted(first.collect()) == [(0, 0), (1, 1), (2, 2)]
    plan = plan_of(first)
    assert plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


def test_keep_first_composite(spark):
    rows = [(1, 1, 9.0), (1, 1, 3.0), (1, 2, 5.0)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    assert sorted(keep_first(df, ["a", "b"]).collect()) == [(1, 1, 3.0), (1, 2, 5.0)]


def test_namespacing(spark):
    df = spark.createDataFrame([("7",), (" 8 ",), ("9.0",), ("10.7",), ("x",), (None,)], "OrderID string")
    found = sorted(r[0] for r in namespace_ids(df).collect())
    assert found == [200007, 200008, 200009, 200010]
    with pytest.raises(KeyError, match="OrderID"):
        namespace_ids(df.withColumnRenamed("OrderID", "Order"))


def test_other_source_must_stay_below_the_namespace(spark):
    df = spark.createDataFrame([(5,), (None,), (200000,)], "OrderID long")
    assert require_below(df, "OrderID", 200001).count() == 3
    with pytest.raises(Exception, match="namespace"):
        require_below(df, "OrderID", 200000).collect()


def test_orders_of_both_sources_do_not_collide(spark):
    sheet = spark.createDataFrame([("1", "A")], "OrderID string, CustomerID string")
    sql = spark.createDataFrame([(1, "B")], "OrderID int, CustomerID string")
    merged = merge_table(S.ORDERS, {"Orders": sheet}, {"Orders": sql})
    assert sorted(r.OrderID for r in merged.collect()) == [1, 200001]
