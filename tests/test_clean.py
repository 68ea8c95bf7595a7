import datetime as dt

import pytest
from pyspark.sql import functions as F

from starloom import schemas as S
from starloom.functions import clean


def values(spark, data, column, schema="v string"):
    df = spark.createDataFrame([(v,) for v in data], schema)
    return [r[0] for r in df.select(column).collect()]


def test_number_is_tolerant(spark):
    text = [" 12 ", "1e3", "abc", "1,5", "", "0x10", "nan", None, "5d", "7f ", "-2.5", "inf", "1_0"]
    assert values(spark, text, clean.number(F.col("v"))) == [
        12.0, 1000.0, None, None, None, None, None, None, None, None, -2.5, float("inf"), None,
    ]
    doubles = values(spark, [1.5, float("nan"), None], clean.number(F.col("v"), False), "v double")
    assert doubles == [1.5, None, None]


def test_truncated_id_cuts_the_fraction_and_keeps_long_numbers(spark):
    text = ["7", " 8 ", "9.0", "10.7", "x", None, "9007199254740993", "1e30"]
    found = values(spark, text, clean.truncated_id(F.col("v")))
    assert found == [7, 8, 9, 10, None, None, 9007199254740993, None]


def test_whole_key_rejects_fractions(spark):
    text = ["1.0", "1.5", "3", "x", None]
    assert values(spark, text, clean.whole_key(F.col("v"))) == [1, None, 3, None, None]
    doubles = values(spark, [2.0, 2.5], clean.whole_key(F.col("v"), False), "v double")
    assert doubles == [2, None]


def test_timestamps(spark):
    text = ["2006-04-25 17:03:55", "2006-04-25", "soon", None]
    parsed = [dt.datetime(2006, 4, 25, 17, 3, 55), dt.datetime(2006, 4, 25), None, None]
    assert values(spark, text, clean.timestamp(F.col("v"))) == parsed
    good = [text[0], None]
    assert values(spark, good, clean.strict_timestamp(F.col("v"))) == [parsed[0], None]
    with pytest.raises(Exception, match="not a timestamp: soon"):
        values(spark, text, clean.strict_timestamp(F.col("v")))


def test_date_parts(spark):
    ts = F.col("v").cast("timestamp_ntz")
    row = values(
        spark,
        ["2006-04-05 17:03:55"],
        F.struct(
            clean.date_key(ts),
            clean.month_label(ts),
            clean.midnight(ts),
            clean.first_of_month(F.year(ts), F.month(ts)),
        ),
    )[0]
    assert tuple(row) == (20060405, "2006-04", dt.datetime(2006, 4, 5), dt.date(2006, 4, 1))
    default = values(spark, [None], clean.or_default_date(ts))
    assert default == [dt.datetime(1996, 1, 1)]


def test_flag(spark):
    text = ["True", "False", "0", "1", None, "maybe"]
    found = values(spark, text, clean.flag(F.col("v")))
    assert found == [True, False, False, True, False, False]
    assert values(spark, [0, 1, 7, None], clean.flag(F.col("v"), False), "v int") == [
        False, True, True, False,
    ]


def test_defaults_tokens_and_names(spark):
    zero = values(spark, [None, float("nan"), 2.0], clean.or_zero(F.col("v")), "v double")
    assert zero == [0.0, 0.0, 2.0]
    tokens = ["nan", "None", "NA", "", "Nanette", None]
    assert values(spark, tokens, clean.null_tokens_to_null(F.col("v"))) == [
        None, None, None, None, "Nanette", None,
    ]
    assert values(spark, [" K-17 ", None], clean.text_key(F.col("v"))) == ["K-17", None]
    names = values(spark, ["Ana", None], clean.full_name(F.col("v"), F.lit("López")))
    assert names == ["Ana López", None]


def test_conform_brings_text_and_numbers_to_one_type(spark):
    text = spark.createDataFrame([("1.0", " A ", "x")], "EmployeeID string, City string, Extra string")
    typed = spark.createDataFrame([(1, "A")], "EmployeeID int, City string")
    a, b = clean.conform(text, S.EMPLOYEES), clean.conform(typed, S.EMPLOYEES)
    assert a.schema.simpleString() == b.schema.simpleString() == (
        "struct<EmployeeID:bigint,City:string>"
    )
    assert a.first() == (1, " A ")


def test_no_number_by_notation(spark):
    texts = ["0x1p3", "0X10", "5d", "7F", "1.5f ", "inf", "-Infinity", "1e3", " 2 ", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(clean.number(F.col("t")).alias("n"))
    inf = float("inf")
    assert [r.n for r in df.collect()] == [None, None, None, None, None, inf, -inf, 1000.0, 2.0, None, None, None]
