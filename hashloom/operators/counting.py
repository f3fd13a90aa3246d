"""Distinct-sample counts that are kept up load by load.

A count of distinct samples isn't additive, a set of samples is: samples are numbered, and a hash's samples are a bitmap of
their numbers, in rows of 64 bits (ksize, hash, bucket, word, bits). A load adds the rows that its own occurrences make; OR merges them with
those of earlier loads, and the bits that are set are the count. Occurrences of earlier loads aren't read again. Rows of 64 bits and not
bitmaps of 32,768: most hashes are in one or two samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import tasks
from ..sources.versions import VersionedTable
from .dedup import ranked

#: Samples up to which their numbers are broadcast.
BROADCAST_SAMPLES = 500_000
KEY = ["ksize", "hash", "bucket"]


class SampleCounts:
    """The bitmaps below a folder. Loads are counted once each, however often they are repeated, and may come from several programs at once."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.samples, self.words = VersionedTable(spark, f"{root}/samples"), VersionedTable(spark, f"{root}/words")

    def _number(self, ids: DataFrame) -> DataFrame:
        """(sample_id, number) of all samples, after new numbers for those of ``ids`` that have none."""
        if self.samples.version() < 0:
            self.samples.append(self.spark.createDataFrame([], "sample_id string, number long"), "start")

        def change(known: DataFrame, _: dict) -> DataFrame | None:
            new = ids.join(known.select("sample_id"), "sample_id", "left_anti")
            if new.isEmpty():
                return None
            first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
            return ranked(new, "sample_id").select("sample_id", (F.col("_place") + first).cast("long").alias("number"))

        self.samples.update(change)
        return self.samples.read()

    def load(self, occurrences: DataFrame, load: str) -> int:
        """Takes up a load (sample_id, ksize, hash, bucket) under a name of its own; the version of the bitmaps after it. Null sample ids don't count, but their hashes are there with 0."""
        if load in self.words.snapshot()["notes"].get("loads", []):
            return self.words.version()
        rows = tasks.more(occurrences.select(F.col("sample_id").cast("string").alias("sample_id"), *KEY), *KEY).distinct()
        numbers = self._number(rows.select("sample_id").where("sample_id IS NOT NULL").distinct())
        side = F.broadcast(numbers) if numbers.count() <= BROADCAST_SAMPLES else numbers
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("number").bitwiseAND(F.lit(63)).cast("int"))
        found = rows.join(side, "sample_id", "left").select(*KEY, F.coalesce(F.shiftright("number", 6), F.lit(0)).cast("long").alias("word"), F.coalesce(bit, F.lit(0)).cast("long").alias("bits"))
        return self.words.append(found.groupBy(*KEY, "word").agg(F.bit_or("bits").alias("bits")), load)

    def bitmaps(self) -> DataFrame:
        """(ksize, hash, bucket, word, bits) over all loads."""
        return _merged(self.words.read(), KEY)

    def counts(self, by_ksize: bool = True) -> DataFrame:
        """([ksize], hash, bucket, n_samples): what one batch over all loads would count; one exchange."""
        keys = KEY if by_ksize else KEY[1:]
        return _merged(self.words.read(), keys).groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("long").alias("n_samples"))

    def compact(self, parts: int = 8) -> int:
        """One part of bitmaps instead of one a load, where there are ``parts`` at least."""
        return self.words.compact(lambda rows: _merged(rows.drop("seq"), KEY), parts)


def _merged(rows: DataFrame, keys: list[str]) -> DataFrame:
    # dealt by the hash once: both the words' OR and the sum over words find their rows together
    return tasks.dealt(rows, *keys).groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"))
