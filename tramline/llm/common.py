"""What the corpus operators share: tables, stored intermediate results, words, row iteration.

Intermediate results are Parquet files in the folder that all executors share
(``spark.checkpoint.dir``). They cut the lineage, so a lost executor costs the
tasks it ran and nothing before them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Largest table, in bytes, that an operator broadcasts after it has counted its rows.
BROADCAST_BYTES = 32 << 20

#: A-Z to a-z, and every ASCII character but digits and letters to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: A-Z to a-z.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Rows of an Arrow batch at most, so that a batch of whole texts stays small outside the heap.
BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder; from now on the session's Arrow batches have at most BATCH_ROWS rows."""
    rows_now = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows_now, "10000")) <= BATCH_ROWS:
        spark.conf.set(rows_now, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession, least: int) -> int:
    """Partitions of a shuffle: as many as the session has, and ``least`` at least, so that their size doesn't grow with the data."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), least)


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local one only where that is unset and the master is local, as in tests."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = "/tmp/tramline-checkpoints"
    return f"{top.rstrip('/')}/tramline-{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once and read again: its rows, and row numbers in them, no longer change.

    A task writes the few values of ``partition_by`` side by side, so it has no rows to sort by them.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    writer = df.write.option("compression", compression)
    if partition_by:
        side_by_side = "spark.sql.maxConcurrentOutputFileWriters"
        before = spark.conf.get(side_by_side, "0")
        spark.conf.set(side_by_side, "8")
        try:
            writer.partitionBy(*partition_by).parquet(path)
        finally:
            spark.conf.set(side_by_side, before)
    else:
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out.select(*df.columns)


def small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within BROADCAST_BYTES, else as it is."""
    return F.broadcast(df) if (df.count() if rows is None else rows) * row_bytes <= BROADCAST_BYTES else df


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "left", parts: int = 64, share: int = 4096, sizes: DataFrame | None = None, total: int | None = None) -> DataFrame:
    """left join right on a key of which right has one row; rows of a hot key are dealt over ``parts`` salts.

    A key is hot if it holds more than one row in ``share``, so there are fewer
    than ``share`` hot keys, and their list is small enough to broadcast. Where
    the rows of each key are known, ``sizes`` (key, n) and ``total`` say so.
    """
    least = max(8, (left.count() if total is None else total) // share + 1)
    each = left.groupBy(key).agg(F.count("*").alias("n")) if sizes is None else sizes
    hot = F.broadcast(each.where(F.col("n") > least).select(F.col(key).alias("_tl_hot")))
    dealt = left.join(hot, F.col(key) == F.col("_tl_hot"), "left").withColumn("_tl_salt", F.when(F.col("_tl_hot").isNotNull(), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts))).otherwise(0).cast("int")).drop("_tl_hot")
    salts = F.when(F.col("_tl_hot").isNotNull(), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.join(hot, F.col(key) == F.col("_tl_hot"), "left").withColumn("_tl_salt", F.explode(salts)).drop("_tl_hot")
    return dealt.join(copied, [key, "_tl_salt"], how).drop("_tl_salt")


def join_labels(docs: DataFrame, labels: DataFrame, row_bytes: int) -> DataFrame:
    """docs join labels, one row for each id, on doc_id; ids of different types are equal if they read alike."""
    if docs.schema["doc_id"].dataType != labels.schema["doc_id"].dataType:
        labels = labels.withColumn("_tl_label", F.col("doc_id").cast("string")).drop("doc_id")
        return docs.join(small(labels, row_bytes), docs["doc_id"].cast("string") == F.col("_tl_label")).drop("_tl_label")
    return docs.join(small(labels, row_bytes), "doc_id")


def text_key(text: str | Column = "text") -> Column:
    """16 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased; null has none."""
    return text.translate(WORD_BYTES).split() if text else []


def rows(batches: Iterable[pa.RecordBatch], *columns: str, step: int = 256) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a few at a time; strings come as UTF-8 bytes."""
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            cells = []
            for name in columns:
                cell = part.column(part.schema.get_field_index(name))
                if pa.types.is_string(cell.type) or pa.types.is_large_string(cell.type):
                    cell = cell.cast(pa.binary() if pa.types.is_string(cell.type) else pa.large_binary())
                cells.append(cell.to_pylist())
            yield from zip(*cells, strict=True)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Buffer:
    """Collects output rows and hands them on as Arrow batches of a bounded number of rows."""

    def __init__(self, schema: pa.Schema, most: int = 4096):
        self.schema, self.most, self.columns = schema, most, [[] for _ in schema]

    def add(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    @property
    def full(self) -> bool:
        return len(self.columns[0]) >= self.most

    def take(self) -> pa.RecordBatch:
        out = batch_of(self.schema, self.columns)
        self.columns = [[] for _ in self.schema]
        return out


def partition_number() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def arrow_schema(df: DataFrame) -> pa.Schema:
    return to_arrow_schema(df.schema)
