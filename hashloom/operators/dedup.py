"""Deduplication of hash occurrences, with counts of distinct samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import tasks
from ..scratch import Scratch


def unique_hashes(df: DataFrame, by_ksize: bool = True, with_counts: bool = False, n_tasks: int = 0) -> DataFrame:
    """Distinct hashes: [ksize], hash, bucket, [n_samples].

    ``by_ksize`` keeps k sizes apart; without it a hash counts once over all.
    ``with_counts`` adds the number of distinct samples (nulls don't count). The
    bucket follows from the hash and rides along in the key. A hash that is in
    every sample is pre-aggregated per task before each exchange; beyond the session's
    number of tasks rows are dealt by their keys first, over ``n_tasks`` or as many as their bytes ask for.
    """
    keys = [*(["ksize"] if by_ksize else []), "hash", "bucket"]
    if not with_counts:
        return tasks.more(df.select(*keys), *keys, n=n_tasks).distinct()
    return tasks.more(df.select("sample_id", *keys), *keys, n=n_tasks).groupBy(*keys).agg(F.count_distinct("sample_id").alias("n_samples"))


def bucket_histogram(df: DataFrame) -> DataFrame:
    """(bucket, n_rows)."""
    return df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"))


def keep_ksizes(df: DataFrame, ksizes) -> DataFrame:
    """Rows of these k sizes; an empty list keeps all. The filter reaches a Parquet scan."""
    wanted = [int(k) for k in ksizes]
    return df.where(F.col("ksize").isin(wanted)) if wanted else df


def ranked(df: DataFrame, *order_by: str) -> DataFrame:
    """The columns ``order_by`` (unique together) with _place (from 0) and _total.

    A place is a row's own in its range partition plus the rows of the
    partitions before; only the counts of partitions meet in one task. The ranges are written first, so
    that all that reads them sees the same ones.
    """
    scratch = Scratch(df.sparkSession, "ranked")
    blocks = scratch.write(df.select(*order_by).repartitionByRange(*order_by).withColumn("_p", F.spark_partition_id()), "blocks")
    sizes = blocks.groupBy("_p").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select(
        "_p",
        F.coalesce(F.sum("_rows").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    local = blocks.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*order_by)) - 1)
    return local.join(starts, "_p").select(*order_by, (F.col("_start") + F.col("_k")).alias("_place"), "_total")


def even_chunks(df: DataFrame, order_by: str, workers: int) -> DataFrame:
    """``df`` with the worker (0 to workers - 1) of an even split in the order of a column with unique values; the first workers get one row more."""
    i, small, extra = F.col("_place"), F.floor(F.col("_total") / workers), F.col("_total") % workers
    cut = extra * (small + 1)
    worker = F.when(i < cut, F.floor(i / (small + 1))).otherwise(extra + F.floor((i - cut) / F.greatest(small, F.lit(1))))
    return df.join(ranked(df, order_by).select(order_by, worker.cast("int").alias("worker")), order_by)
