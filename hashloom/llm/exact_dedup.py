"""Exact deduplication by tree-merging sorted digest runs (DataFrame operations only).

The digests of all texts are written once. A partition's digests are a run: sorted, its distinct text
identities each with the smallest identifier and the row count. Runs merge in binomial rounds: in
a round the runs whose numbers agree but for the lowest ``fan_in`` bits are exchanged and merged, and
after the last round one run is left, in which an identity has one row.

A run is cut by digest, so that a merge is the work of all tasks and never of
one: a round is one exchange of rows dealt by (run, identity), whose sender sorts and folds its rows
before, and whose receiver merges what it gets in the order of digests (sort aggregates on both sides, since the
identifier is folded as a struct). Identity is (SHA-256, byte length, XXH64): the last two verify the
digest at each level, since unequal texts with one digest stay apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

_KEY = ["_sha", "_len", "_xx"]


def digest_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _sha, _len, _xx, _run) of each row; a null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col).alias("_id"),
        F.unhex(F.sha2(text, 256)).alias("_sha"),
        F.octet_length(text).alias("_len"),
        F.xxhash64(text).alias("_xx"),
        F.spark_partition_id().alias("_run"),
    )


def tree_merge(rows: DataFrame, n_runs: int, fan_in: int = 4, keep: str = "min") -> DataFrame:
    """One row per identity: ``_keep`` (the smallest or largest id) and ``_size``.

    ``fan_in`` is the number of low bits of the run number that a round merges
    (2**fan_in runs meet). The rounds grow with log(n_runs); a group of copies,
    however large, has at most one row per run and round.
    """
    # a null id is chosen only where there is no other: the flag comes first
    known = F.col("_id").isNotNull()
    one = F.struct((~known if keep == "min" else known).alias("u"), F.col("_id").alias("id"))
    best = F.min if keep == "min" else F.max
    level = rows.select("_run", *_KEY, one.alias("_best"), F.lit(1).cast("long").alias("_size"))
    left = max(1, n_runs)
    while True:
        left = -(-left // (1 << fan_in))
        run = F.shiftright("_run", fan_in) if left > 1 else F.lit(0)
        level = level.withColumn("_run", run).groupBy("_run", *_KEY).agg(best("_best").alias("_best"), F.sum("_size").alias("_size"))
        if left == 1:
            return level.select(*_KEY, F.col("_best.id").alias("_keep"), "_size")


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fan_in: int = 4) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their UTF-8 bytes are identical. The row with the
    smallest (``keep="min"``) or largest identifier stays.

    Null text: as empty, so null and empty texts are one group. Null id: never
    chosen while another row of the group has one; such a row is kept only if
    all ids of its group are null. Repeated rows (same id and text): each is
    returned, each counted in group_size, and all with the kept id are kept. Very long texts: only
    their digests move. Empty table: no rows. Extra columns of ``df`` are not read.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep is 'min' or 'max'")
    scratch = Scratch(df.sparkSession, "exact")
    n_runs = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = scratch.write(digest_rows(df, id_col, text_col).withColumn("_run", F.pmod("_run", F.lit(n_runs))), "digests")
    merged = tree_merge(rows, n_runs, fan_in, keep)
    return (
        rows.drop("_run")
        .join(merged, _KEY)
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_keep").alias("keep_id"),
            F.col("_size").alias("group_size"),
            F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
            F.lower(F.hex("_sha")).alias("text_sha256"),
        )
    )
