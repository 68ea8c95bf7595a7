"""Tolerant casts, defaults and keys as plain column expressions.

Spark 4 runs with ANSI casts, so everything that must not fail on bad input goes through
``try_cast``. ``text`` says whether the column is a string; numeric columns skip the text rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S


def number(col: Column, text: bool = True) -> Column:
    """Double, or null where the value is no number. NaN counts as missing."""
    parsed = F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))
    if not text:
        return parsed
    # The JVM reads "5d", "7f" and "0x1p3" as numbers; they are text here.
    end = F.lower(F.right(F.rtrim(col, F.lit(" \t\r\n")), F.lit(3)))
    marked = F.right(end, F.lit(1)).isin("d", "f") & (end != "inf")
    return F.when(~(marked | F.contains(F.lower(col), F.lit("x"))), parsed)


def truncated_id(col: Column, text: bool = True) -> Column:
    """Bigint with the fraction cut off, or null where the value is no number."""
    # Whole-number text is cast directly: beyond 2**53 a double would lose digits.
    return F.coalesce(col.try_cast("bigint"), number(col, text).try_cast("bigint"))


def whole_key(col: Column, text: bool = True) -> Column:
    """Bigint, or null where the value is no whole number ("1.0" is one, "1.5" is not)."""
    as_double = number(col, text)
    via_double = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(col.try_cast("bigint"), via_double) if text else via_double


def text_key(col: Column) -> Column:
    """Trimmed text; null stays null."""
    return F.trim(col.cast("string"))


def timestamp(col: Column) -> Column:
    """Timestamp without zone, or null where the text is no timestamp."""
    return col.try_cast("timestamp_ntz")


def strict_timestamp(col: Column) -> Column:
    """Timestamp without zone; text that is no timestamp fails the query."""
    parsed = col.try_cast("timestamp_ntz")
    bad = col.isNotNull() & parsed.isNull()
    message = F.concat(F.lit("not a timestamp: "), col.cast("string"))
    return F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(parsed)


def flag(col: Column, text: bool = True) -> Column:
    """Boolean, false where missing. The text "False" is false; a non-zero number is true."""
    parsed = col.try_cast("boolean")
    if text:
        parsed = F.coalesce(parsed, number(col) != 0)
    return F.coalesce(parsed, F.lit(False))


def null_tokens_to_null(col: Column) -> Column:
    """Null where the text is one of the tokens that mean missing."""
    return F.when(~col.isin(*S.NULL_TOKENS), col)


def or_zero(col: Column) -> Column:
    """0.0 in place of null or NaN."""
    return F.coalesce(F.nanvl(col, F.lit(None).cast("double")), F.lit(0.0).cast("double"))


def or_default_date(col: Column, default: str = S.DEFAULT_ORDER_DATE) -> Column:
    return F.coalesce(col, F.lit(default).cast("timestamp_ntz"))


def date_key(ts: Column) -> Column:
    """Day as the integer yyyyMMdd."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def midnight(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def full_name(first: Column, last: Column) -> Column:
    """``first last``, null when either part is null."""
    return F.concat(first, F.lit(" "), last)


def line_total(price: Column, quantity: Column, discount: Column) -> Column:
    return price * quantity * (F.lit(1) - discount)


def _clean(col: Column, kind: str, is_text: bool, dtype: T.DataType, strict_dates: bool) -> Column:
    if kind in (S.ID, S.INT_KEY, S.COUNT):
        if isinstance(dtype, T.IntegralType):
            return col.cast("bigint")
        return whole_key(col, is_text) if kind == S.INT_KEY else truncated_id(col, is_text)
    if kind == S.NUMBER:
        return number(col, is_text)
    if kind == S.TEXT_KEY:
        return text_key(col)
    if kind == S.TIMESTAMP:
        return strict_timestamp(col) if strict_dates else timestamp(col)
    if kind == S.FLAG:
        # Missing stays missing until the product dimension decides on it.
        return F.when(col.isNotNull(), flag(col, is_text))
    return col.cast("string")


def _conformed(df: DataFrame, table: S.SourceTable, strict_dates: bool, keep: Sequence[str]) -> list[Column]:
    types = {field.name: field.dataType for field in df.schema}
    out = []
    for name, kind in table.columns.items():
        if name not in types:
            continue
        dtype = types[name]
        is_text = isinstance(dtype, T.StringType)
        out.append(_clean(F.col(name), kind, is_text, dtype, strict_dates).alias(name))
    return out + [F.col(name).cast("string").alias(name) for name in keep if name in types]


def conform(
    df: DataFrame, table: S.SourceTable, strict_dates: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Cast the contract columns ``df`` has to their contract types.

    Of other columns those named in ``keep`` stay, as text; a source may lack them.

    Both sources of a merge go through this first, so that a text key on one side and a numeric
    key on the other meet in one type.
    """
    return df.select(*_conformed(df, table, strict_dates, keep))


# Why a cell has no value although it holds something, by the kind of its column.
REASONS = {
    S.ID: "not a number",
    S.INT_KEY: "not a whole number",
    S.NUMBER: "not a number",
    S.COUNT: "not a number",
    S.TIMESTAMP: "not a timestamp",
    S.FLAG: "not a flag",
}
REJECTS = "_rejects"


def rejects(df: DataFrame, table: S.SourceTable) -> Column:
    """``column_name, text, reason`` of each cell of a row that can't be read, as one array.

    Nulls, blank cells and the usual tokens for missing values are missing, not rejected.
    """
    types = {field.name: field.dataType for field in df.schema}
    found = []
    for name, kind in table.columns.items():
        if name not in types or kind not in REASONS:
            continue
        col, is_text = F.col(name), isinstance(types[name], T.StringType)
        if kind == S.FLAG:
            value = F.coalesce(col.try_cast("boolean"), number(col) != 0) if is_text else col.try_cast("boolean")
        else:
            value = _clean(col, kind, is_text, types[name], strict_dates=False)
        bad = col.isNotNull() & value.isNull()
        if is_text:
            bad = bad & ~F.trim(col).isin(*S.NULL_TOKENS)
        cell = F.struct(F.lit(name).alias("column_name"), col.cast("string").alias("text"), F.lit(REASONS[kind]).alias("reason"))
        found.append(F.when(bad, cell))
    none = F.array().cast("array<struct<column_name: string, text: string, reason: string>>")
    return F.filter(F.array(*found), lambda cell: cell.isNotNull()) if found else none


def conform_with_rejects(df: DataFrame, table: S.SourceTable, keep: Sequence[str] = ()) -> DataFrame:
    """``conform``, and the row's rejected cells in one more column, ``REJECTS``.

    Stored once, such a table is both the clean rows and the quarantine: a reader of either reads
    its own columns only.
    """
    return df.select(*_conformed(df, table, False, keep), rejects(df, table).alias(REJECTS))
