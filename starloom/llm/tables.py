"""Input tables and tables in the shared folder."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
import uuid
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@cache
def _ship(application: str, spark: SparkSession) -> None:
    """Give the executors this package, as ``spark-submit --py-files`` would."""
    root = Path(__file__).parents[1]
    base = f"{tempfile.mkdtemp()}/{root.name}"
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root.parent, root.name))


def ship(spark: SparkSession) -> None:
    _ship(spark.sparkContext.applicationId, spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new folder that the driver and all executors reach.

    It lies in ``spark.checkpoint.dir``, or beside Spark's tables where that is unset (as in
    tests).
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: what follows outlives lost executors and does not compute ``df``
    again.
    """
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return a worker's free memory to the system: workers outlive their tasks, and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_batches(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, under fixed names, whatever else ``df`` holds."""
    return df.select(df[key].alias("doc_id"), df[text].cast("string").alias("text"))
