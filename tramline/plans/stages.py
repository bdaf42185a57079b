"""A job in stages: tables that are written once, read again, and not made anew when the job is started again."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tramline.sources.sinks import work_folder


#: Largest table that a stage's joins broadcast by the size of its files; beyond it they go by the measured size of its rows.
UNMEASURED = "256k"


@contextmanager
def measured_joins(spark: SparkSession) -> Iterator[None]:
    """Within, larger tables are broadcast only after a shuffle has measured them, up to the session's own threshold.

    Files are compressed, so their size says little of the memory that their rows take on the driver: a table of 10 MB
    of Parquet was broadcast as 281 MB.
    """
    by_files, by_rows = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before, own = spark.conf.get(by_files), spark.conf.get(by_rows, None)
    if before.startswith("-"):  # the session broadcasts nothing by size
        yield
        return
    spark.conf.set(by_rows, own or before)
    spark.conf.set(by_files, UNMEASURED)
    try:
        yield
    finally:
        spark.conf.set(by_files, before)
        if own is None:
            spark.conf.unset(by_rows)
        else:
            spark.conf.set(by_rows, own)


def missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


class Stages:
    """Tables by name below a folder that all executors share; without one, in a new folder of the session.

    A stage's rows are written to a path of their own, and a note that names the path follows when they are whole. So
    what a job left unfinished is never read, a job that is started again on its folder goes on behind its last whole
    stage, and a lost executor costs its own tasks. A folder belongs to one job on one set of inputs.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, (folder or work_folder(spark)).rstrip("/")
        self.made: list[str] = []

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table of a stage: read if it is whole, else made by ``make`` and written first."""
        note = self._note(name)
        if note is None:
            df, path = make(), f"{self.folder}/{name}-{uuid.uuid4().hex}"
            with measured_joins(self.spark):
                df.write.parquet(path)
            note = (path, df.schema.json())
            self.spark.createDataFrame([note], "path string, schema string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/whole/{name}")
            self.made.append(name)
        path, schema = note
        return self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(path)

    def _note(self, name: str) -> tuple[str, str] | None:
        try:
            row = self.spark.read.schema("path string, schema string").parquet(f"{self.folder}/whole/{name}").first()
        except AnalysisException as error:
            if missing(error):
                return None
            raise
        return row and (row["path"], row["schema"])
