"""Star tables built once and shared by many reports."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from starloom.plans.star_schema import Star
from starloom.sources import files


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir``, or where Spark's own tables lie."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def shared_place(spark: SparkSession, purpose: str, what: object) -> str:
    """The folder for ``what`` (by its ``repr``), the same in every session."""
    return f"{shared_folder(spark)}/{purpose}-{hashlib.md5(repr(what).encode()).hexdigest()}"


def source_state(spark: SparkSession, source_paths: dict[str, str]) -> str:
    """Changes when a file of any source does."""
    return hashlib.md5(repr(files.state(spark, source_paths)).encode()).hexdigest()


class StoredStars:
    """Stars kept as tables, built again when the files they come from change.

    The tables lie in the shared folder, so they outlive lost executors. A manifest, written last
    and named after the state of the sources, says where: later sessions find the star by it, and a
    build that failed leaves none.
    """

    def __init__(self, database_first: bool = False) -> None:
        self._database_first = database_first

    def path(
        self, spark: SparkSession, source_paths: dict[str, str], build: Callable[[], Star]
    ) -> str:
        """Folder of the star built from these sources in their present state."""
        state = (self._database_first, sorted(source_paths.items()), files.state(spark, source_paths))
        name = hashlib.md5(repr(state).encode()).hexdigest()
        manifest = f"{shared_folder(spark)}/manifest-{name}"
        path = files.read_note(spark, manifest)
        if path is None or not files.has_star(spark, path):
            path = new_folder(spark, "star")
            files.write_star(build(), path)
            files.write_note(spark, manifest, path)
        return path

    def get(
        self, spark: SparkSession, source_paths: dict[str, str], build: Callable[[], Star]
    ) -> Star:
        path = self.path(spark, source_paths, build)
        return files.read_star(spark, path, database_first=self._database_first)
