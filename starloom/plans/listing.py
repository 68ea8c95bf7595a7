"""The detail listing in pages: sorted once, then a page reads the files that hold it.

The listing is stored in its order, a file per range of it. A zone map, stored beside, says for each
file how many rows lie before it, how many it has and which key it begins with. Within a file
Parquet numbers the rows, so a row's place in the whole listing is known without reading others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.plans import reports
from starloom.plans.reports import View

_PLACE = "_place"


def store(view: View, path: str) -> None:
    """Write the listing of a view and its zone map below ``path``."""
    spark = view.star.fact_sales.sparkSession
    reports.detail_table(view).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows").withColumn("file", F.col("_metadata.file_name"))
    first = F.min_by(F.struct("date", "OrderKey"), "_metadata.row_index").alias("first")
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), first)
    # A row per file; the writer's tasks number them in the order of the listing.
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint"))
    files.withColumn("start", start).write.parquet(f"{path}/zones")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """``file, rows, first, start`` of each file of a stored listing."""
    return spark.read.parquet(f"{path}/zones")


def page(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """Rows ``number * size`` and on of a stored listing, ``size`` at most; pages count from 0.

    Only the files that hold them are opened. A page behind the last one has no rows.
    """
    if number < 0 or size < 1:
        raise ValueError("pages count from 0 and have a row at least")
    begin, end = number * size, (number + 1) * size
    held = zones(spark, path).where((F.col("start") < end) & (F.col("start") + F.col("rows") > begin))
    starts = {r.file: r.start for r in held.collect()}
    schema = spark.read.parquet(f"{path}/rows").schema
    if not starts:
        return spark.createDataFrame([], schema)
    parts = [
        spark.read.schema(schema).parquet(f"{path}/rows/{file}").withColumn(_PLACE, F.col("_metadata.row_index") + start)
        for file, start in sorted(starts.items(), key=lambda x: x[1])
    ]
    rows = reduce(DataFrame.unionByName, parts).where(F.col(_PLACE).between(begin, end - 1))
    return rows.orderBy(_PLACE).drop(_PLACE)
