"""Read file extracts and stored star tables; write them; fingerprint them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S
from starloom.functions import clean
from starloom.plans.star_schema import Star, calendar_of_fact, day_calendar
from starloom.sources.layout import FACT_PARTITION


def normalise_headers(df: DataFrame) -> DataFrame:
    """Remove every space from the column names."""
    return df.toDF(*[c.replace(" ", "") for c in df.columns])


def if_present(load: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return load()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_extract(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    multi_line: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame | None:
    """A file extract with normalised headers, or None where there is none.

    ``only`` names some of its files, which are read with the columns of the whole. CSV rows that are shorter or longer than the header fail the query. ``multi_line`` is for
    fields that hold line breaks; each file is then read by one task.

    CSV columns stay text, with the usual tokens for missing values as nulls; the contract of
    the table they are merged into decides on types.
    """
    reader = _csv_reader(spark, multi_line) if fmt == "csv" else spark.read.format(fmt)
    df = if_present(lambda: reader.load(path))
    if df is None:
        return None
    if only is not None:
        df = reader.schema(df.schema).load(list(only))
    df = normalise_headers(df)
    if fmt != "csv":
        return df
    return df.select([clean.null_tokens_to_null(F.col(c)).alias(c) for c in df.columns])


# Quotes inside a quoted field are doubled, as spreadsheets and pandas write them.
_CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _csv_reader(spark: SparkSession, multi_line: bool = False) -> DataFrameReader:
    """Rows are checked against the header even where only some columns are asked for.

    Without ``multi_line`` fields hold no line breaks, so that many tasks read a large file.
    """
    reader = spark.read.format("csv").options(**_CSV, mode="FAILFAST", columnPruning="false")
    return reader.option("multiLine", multi_line)


def _without_line_breaks(df: DataFrame) -> DataFrame:
    """Fail the query on a text that holds a line break."""

    def checked(name: str) -> Column:
        broken = F.col(name).rlike("[\\r\\n]")
        message = F.lit(f"line break in {name}; write with multi_line")
        return F.when(broken, F.raise_error(message).cast("string")).otherwise(F.col(name))

    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: checked(name) for name in texts})


def write_csv(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """Overwrite ``path`` with UTF-8 CSV files with a header; nulls become empty fields.

    A text with a line break fails the query, unless ``multi_line`` says that readers know.
    """
    df = df if multi_line else _without_line_breaks(df)
    df.write.mode("overwrite").options(**_CSV).csv(path)


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """A stored CSV table in its contract types; an integer key may be written as ``1.0``."""
    raw = _csv_reader(spark, multi_line).load(path)
    out = []
    for field in schema:
        col = clean.null_tokens_to_null(F.col(field.name))
        if isinstance(field.dataType, T.IntegralType):
            col = clean.whole_key(col).cast(field.dataType)
        elif isinstance(field.dataType, T.DoubleType):
            col = clean.number(col)
        elif not isinstance(field.dataType, T.StringType):
            col = col.cast(field.dataType)
        out.append(col.alias(field.name))
    return raw.select(*out)


def _write_table(name: str, df: DataFrame, path: str, fmt: str) -> None:
    target = f"{path}/{name}"
    if fmt == "csv":
        write_csv(df, target)
    elif name == "fact_sales":
        dated = df.withColumn(FACT_PARTITION, F.year("OrderDate"))
        dated.write.mode("overwrite").partitionBy(FACT_PARTITION).parquet(target)
    else:
        df.write.mode("overwrite").parquet(target)
    if name == "dim_time" and fmt == "parquet":
        days = day_calendar(df.sparkSession.read.parquet(target))
        days.write.mode("overwrite").parquet(f"{path}/dim_day")


def write_star(star: Star, path: str, fmt: str = "parquet") -> None:
    """Write every star table below ``path``; the Parquet fact is partitioned by order year.

    The tables are written side by side: the small ones use what the fact leaves idle. The Parquet
    calendar follows from the stored fact where it may, which spares reading the orders twice.
    """
    tables = star.tables()
    spark = star.fact_sales.sparkSession
    first = "year_month" in star.dim_time.columns
    later = fmt == "parquet" and star.calendar_from_fact
    if later:
        del tables["dim_time"]
    with ThreadPoolExecutor(len(tables)) as pool:
        writes = [pool.submit(_write_table, name, df, path, fmt) for name, df in tables.items()]
    for write in writes:
        write.result()
    if later:
        fact = spark.read.schema(star.fact_sales.schema).parquet(f"{path}/fact_sales")
        _write_table("dim_time", calendar_of_fact(fact, first), path, fmt)
    if fmt == "parquet":
        # Imported here, as reports read what this module stores.
        from starloom.plans.reports import known_values

        known = known_values(read_star(spark, path, fmt, first))
        known.write.mode("overwrite").parquet(f"{path}/known")


#: What reports.known_values gives.
KNOWN = T.StructType([T.StructField(c, T.StringType()) for c in ("attribute", "value")])


def _read_table(
    spark: SparkSession,
    path: str,
    name: str,
    fmt: str,
    schema: T.StructType,
    keep: Sequence[str] = (),
) -> DataFrame:
    if name == "fact_sales":
        schema = T.StructType([*schema, *(T.StructField(c, T.StringType()) for c in keep)])
    if fmt == "csv":
        return read_csv_table(spark, f"{path}/{name}", schema)
    if name == "fact_sales":
        schema = T.StructType([*schema, T.StructField(FACT_PARTITION, T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def read_star(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    database_first: bool = False,
    keep: Sequence[str] = (),
) -> Star:
    """A stored star, in the schemas of the variant that wrote it and with the same ``keep``."""
    schemas = S.STAR_TABLES_DATABASE_FIRST if database_first else S.STAR_TABLES
    if fmt == "parquet":
        schemas = schemas | {"dim_day": schemas["dim_time"]}
        if if_present(lambda: spark.read.schema(KNOWN).parquet(f"{path}/known")) is not None:
            schemas = schemas | {"known": KNOWN}
    return Star(
        **{n: _read_table(spark, path, n, fmt, schema, keep) for n, schema in schemas.items()}
    )


def stored_tables(
    spark: SparkSession, path: str, fmt: str = "parquet"
) -> dict[str, DataFrame | None]:
    """The star tables with the columns they really have, None for one that is not there."""
    reader = _csv_reader(spark) if fmt == "csv" else spark.read.format(fmt)
    tables = {}
    for name in S.STAR_TABLES:
        df = if_present(lambda: reader.load(f"{path}/{name}"))
        tables[name] = None if df is None else df.drop(FACT_PARTITION)
    return tables


def has_star(spark: SparkSession, path: str) -> bool:
    """Whether a folder still holds a Parquet star."""
    names = [n for n in S.STAR_TABLES if n != "dim_categories"] + ["known"]
    found = (if_present(lambda: spark.read.schema(KNOWN).parquet(f"{path}/{n}")) for n in names)
    return all(df is not None for df in found)


def write_note(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """A text of one line, or None where there is none."""
    found = if_present(lambda: spark.read.text(path))
    row = None if found is None else found.first()
    return None if row is None else row.value


def list_files(spark: SparkSession, path: str) -> DataFrame | None:
    """``path, url, length, modified`` per file, without opening any; None if there is nothing.

    ``url`` is the path as ``input_file_name`` gives it to readers of the file.
    """
    found = if_present(lambda: _listing(spark, path))
    if found is None:
        return None
    changed = F.col("modificationTime").alias("modified")
    return found.select("path", F.input_file_name().alias("url"), "length", changed)


def _listing(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)


def state(spark: SparkSession, paths: dict[str, str]) -> tuple:
    """One value that changes when a file of any table does; cheaper than the fingerprint."""
    files = if_present(lambda: _listing(spark, list(paths.values())))
    if files is None:
        return tuple(fingerprint(spark, paths).orderBy("table_name").collect())
    # The hashes are shortened so that their sum over many files stays in range.
    file_hash = F.shiftright(F.xxhash64("path", "length", "modificationTime"), 24)
    return tuple(
        files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.sum(file_hash))
        .first()
    )


def fingerprint(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files, bytes and latest change per table, nulls for a table that is not there.

    Only the listing is read: the file contents are pruned away.
    """
    parts = []
    for name, path in paths.items():
        found = if_present(lambda: _listing(spark, path))
        if found is None:
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("table_name"),
                    F.lit(None).cast("bigint").alias("length"),
                    F.lit(None).cast("timestamp").alias("modificationTime"),
                )
            )
        else:
            parts.append(found.select(F.lit(name).alias("table_name"), "length", "modificationTime"))
    listing = reduce(DataFrame.union, parts)
    return listing.groupBy("table_name").agg(
        F.nullif(F.count("length"), F.lit(0)).alias("file_count"),
        F.sum("length").alias("byte_count"),
        F.max("modificationTime").alias("last_modified"),
    )
