"""Writers: silver tables, feed tables as text, packages, audits."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.sources import archive, schemas


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; a temporary one only on a local master."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.gettempdir()
    return f"{top.rstrip('/')}/tramline-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to a new folder that all executors share and read again, so that a loop's plan doesn't grow."""
    return silver(df, work_folder(df.sparkSession))


def silver(df: DataFrame, path: str) -> DataFrame:
    """Replaces a table and reads it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def feed_table(df: DataFrame, name: str) -> DataFrame:
    """A table with the columns of the feed, in their order; those it lacks are null."""
    return df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in schemas.FEED[name]))


#: Cells as RFC 4180 has them: quotes are doubled, blanks are kept.
CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_table(df: DataFrame, folder: str, name: str) -> None:
    """A feed table as CSV with a header, ordered by its key."""
    feed_table(df, name).orderBy(*schemas.KEYS[name]).write.mode("overwrite").options(**CSV).csv(f"{folder}/{name}")


def write_feed(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_table(df, folder, name)


def package(spark: SparkSession, folder: str, names: list[str], target: str, most: int = archive.CHUNK) -> str:
    """One zip of text tables: the sorted part files of each, one after another, below one header.

    Tasks deflate the files' lines; the driver puts the pieces in order, a few at a time, and adds the directory.
    """
    with archive.Archive(f"{target}.part") as out:
        for name in names:
            entry = f"{name}.txt" if name not in ("fare_stages", "special_fare_rules") else f"{name}.csv"
            files = spark.read.option("lineSep", "\n").option("pathGlobFilter", "part-*.csv").text(f"{folder}/{name}")
            pieces = kept(archive.deflated(files.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")), most))
            ordered = pieces.repartitionByRange(max(1, pieces.count()), "file", "start", "place").sortWithinPartitions("file", "start", "place")
            out.add(entry, [archive.deflate(",".join(schemas.FEED[name]).encode() + b"\n")], ((r["n"], r["crc"], bytes(r["bytes"])) for r in ordered.toLocalIterator()))
    os.replace(f"{target}.part", target)
    return target


def audit(df: DataFrame, path: str) -> None:
    """A diagnostic table, kept for people to look at."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(value, path: str) -> None:
    with open(path, "w", encoding="utf-8") as file:
        json.dump(value, file, ensure_ascii=False, indent=2)


def schema_json(df: DataFrame) -> dict:
    return json.loads(df.schema.json())


def shapes_named_by_trip(shapes: DataFrame, trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shapes and trips with each shape renamed to the least id of its trips; shapes without a trip go."""
    names = trips.where("shape_id IS NOT NULL").groupBy("shape_id").agg(F.min("trip_id").alias("_name"))
    renamed = lambda df, how: df.join(names, "shape_id", how).withColumn("shape_id", F.col("_name")).drop("_name")
    return renamed(shapes, "inner"), renamed(trips, "left")
