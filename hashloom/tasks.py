"""Tasks of an exchange that follow the bytes it moves, beyond ``spark.sql.shuffle.partitions``.

Adaptive execution makes tasks fewer, and for keyed work never more: a sort's or an aggregate's memory in a task would grow with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes, as the optimizer sees them, that a task is to get. Of Parquet these are the files' bytes by the columns' share; sorted rows of hashes take some thirty times as much.
TASK_BYTES = 4 << 20


def needed(df: DataFrame, each: int | None = None) -> int:
    """Tasks that get about ``each`` bytes (TASK_BYTES unless given) of ``df``, by the optimizer's estimate; 1 where it has none that says anything."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // (each or TASK_BYTES))) if size < 1 << 50 else 1


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys``, over more tasks than the session's where its bytes ask for them."""
    n = needed(df)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(*keys)


def more(df: DataFrame, *keys: str, n: int = 0) -> DataFrame:
    """``df`` dealt by ``keys`` over ``n`` tasks (those that its bytes ask for, if 0) where these are more than the session's; else as it is, for what follows to deal."""
    n = n or needed(df)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df
