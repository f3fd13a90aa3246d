"""Shared plumbing of the corpus operators: input reading, Arrow views, letting go of shuffle files."""

from __future__ import annotations

import gc
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

__all__ = ["Scratch", "ascii_lower", "dealt_by", "doc_chunks", "load", "numbered", "parts_for", "release", "small_side", "text_views"]

#: Rows up to which a table is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 50_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The whole table ``<sf_dir>/<table>.parquet``, by any path that Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files that no plan refers to any more."""
    for _ in range(2):  # the second pass finds what the first one's finalizers let go
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def parts_for(n_bytes: int, each: int, least: int = 1) -> int:
    """Partitions so that one holds about ``each`` bytes; grows with the input."""
    return max(least, -(-int(n_bytes) // each))


def dealt_by(df: DataFrame, n_tasks: int, key: str) -> DataFrame:
    """``df`` dealt by ``key`` over n_tasks tasks where these are more than spark.sql.shuffle.partitions, so that a task's share stays the same as the input grows."""
    return df.repartition(n_tasks, key) if n_tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def small_side(table: DataFrame) -> DataFrame:
    """A written table as the side of a join: broadcast up to BROADCAST_ROWS rows, shuffled beyond."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def numbered(scratch: Scratch, rows: DataFrame, group: str, order: list[str], name: str, total: str) -> DataFrame:
    """``rows`` with pos, the place in the group (from 0, in the order of the columns ``order``), and the group's rows as ``total``.

    Groups are dealt over the ranges of (group, order), so a large one is the work of many tasks. The ranges are written first, so that all
    that reads them sees the same ones; what meets of a group elsewhere is a row per range.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumns({"_part": F.spark_partition_id(), "_row": row})
    dealt = scratch.write(dealt, name)
    parts = dealt.groupBy(group, "_part").agg(F.min("_row").alias("_from"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("_rows").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = scratch.write(parts.select(group, "_part", (before - F.col("_from")).alias("_shift"), F.sum("_rows").over(own).alias(total)), f"{name}_starts")
    return dealt.join(small_side(starts), [group, "_part"]).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def text_views(batch: pa.RecordBatch, column: str):
    """(uint8 bytes, int64 starts with the end appended, bool nulls) of a string column, without a copy per row."""
    col = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    n = len(col)
    _, offsets, data = col.buffers()
    starts = np.frombuffer(offsets, kind, n + 1, col.offset * kind().itemsize).astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    nulls = np.asarray(col.is_null())
    return raw, starts, nulls


def doc_chunks(starts: np.ndarray, most: int = 1 << 20):
    """(first, end) row ranges whose texts together have about ``most`` bytes; one row at least."""
    n, i = len(starts) - 1, 0
    while i < n:
        j = int(np.searchsorted(starts, starts[i] + most, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def ascii_lower(c):
    """A to Z in lower case; every other character as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
