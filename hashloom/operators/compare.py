"""Comparing collections: hashes known to others, novel ones, containment.

Collections meet on (ksize, hash), never on buckets, whose modulus differs.
Sides are made distinct first, so a join has one row per key and side. Tables loaded
with ``buckets`` join without an exchange.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from ..sources import listings, tables

KEY = ["ksize", "hash"]


def normalised(df: DataFrame, hash_col: str = "hash", ksize_col: str | None = "ksize", ksize: int | None = None) -> DataFrame:
    """Distinct (ksize, hash); a collection without a k column gets the given k size."""
    if ksize_col is None and ksize is None:
        raise ValueError("a collection without a ksize column needs a ksize")
    k = F.col(ksize_col) if ksize_col else F.lit(ksize)
    return df.select(k.cast("smallint").alias("ksize"), F.col(hash_col).cast("bigint").alias("hash")).distinct()


def known(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left whose (ksize, hash) right has."""
    return left.join(right.select(*KEY), KEY, "left_semi")


def novel(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of left whose (ksize, hash) right lacks."""
    return left.join(right.select(*KEY), KEY, "left_anti")


def containment(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per k size of left (distinct rows): n_left, n_known, containment."""
    marked = left.join(right.select(*KEY).withColumn("_k", F.lit(True)), KEY, "left")
    counts = marked.groupBy("ksize").agg(F.count(F.lit(1)).alias("n_left"), F.count_if(F.col("_k").isNotNull()).alias("n_known"))
    return counts.withColumn("containment", F.col("n_known") / F.col("n_left"))


def coverage(left: DataFrame, rights: DataFrame, name: str) -> DataFrame:
    """Per collection of ``rights`` (name, ksize, hash; distinct rows): n_known, the hashes of left that it has; one pass for all collections."""
    return rights.join(left.select(*KEY), KEY, "left_semi").groupBy(name).agg(F.count(F.lit(1)).alias("n_known"))


@contextmanager
def folded_buckets(spark: SparkSession, ratio: int = 16):
    """Joins planned inside read a table of n buckets as one of n / m, where the other has that many: 512 meet 64 without an exchange of either.

    A bucket number is a hash modulo the number of buckets, so with m dividing n a bucket of the smaller table is m whole buckets of the larger. Where neither number divides the
    other (521 and 512), one side is dealt anew, as ``rebucketed`` does it.
    """
    settings = {"spark.sql.bucketing.coalesceBucketsInJoin.enabled": "true", "spark.sql.bucketing.coalesceBucketsInJoin.maxBucketRatio": str(ratio), "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rebucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` dealt as a table of so many buckets is, so that a join with one moves this side alone."""
    return df.repartition(buckets, *KEY)


#: Bits of a mask word: one bit a collection.
WORD = 63


def _words(n: int) -> list[str]:
    return [f"m{k}" for k in range(-(-n // WORD))]


def masks(sets: list[DataFrame]) -> DataFrame:
    """(ksize, hash, m0, m1, ...): which of the collections (ksize, hash; repeats allowed) have each hash; bit i % WORD of word i // WORD stands for the i-th.

    One aggregation, and so one exchange, however many collections there are; what a task has of a hash is one row before it.
    """
    words = _words(len(sets))
    tagged = None
    for i, rows in enumerate(sets):
        own = [(F.lit(1 << i % WORD) if k == i // WORD else F.lit(0)).cast("long").alias(w) for k, w in enumerate(words)]
        one = rows.select(F.col("ksize").cast("smallint").alias("ksize"), F.col("hash").cast("long").alias("hash"), *own)
        tagged = one if tagged is None else tagged.unionByName(one)
    return tagged.groupBy(*KEY).agg(*(F.bit_or(w).alias(w) for w in words))


def mask_counts(masked: DataFrame) -> DataFrame:
    """(ksize, m0, ..., n): how many hashes have each combination of collections."""
    words = [c for c in masked.columns if c not in KEY]
    return masked.groupBy("ksize", *words).agg(F.count(F.lit(1)).alias("n"))


def _members(words: list[str], of: list[int]):
    """The numbers among ``of`` whose bit is set, as an array."""
    return F.array_compact(F.array(*(F.when(F.col(words[i // WORD]).bitwiseAND(F.lit(1 << i % WORD).cast("long")) != 0, F.lit(i)) for i in of)))


def overlaps(counts: DataFrame, names: list[str], left: list[int], right: list[int]) -> DataFrame:
    """(ksize, left_set, right_set, n_left, n_right, n_shared, containment) of all pairs of a left and a right collection, from mask counts.

    Pairs that share nothing are there with 0, at every k size that either has.
    """
    words = [c for c in counts.columns if c not in ("ksize", "n")]
    name = F.array(*map(F.lit, names))
    sides = counts.select("ksize", "n", _members(words, left).alias("l"), _members(words, right).alias("r"))
    size_of = lambda side, out: sides.select("ksize", F.explode(side).alias("i"), "n").groupBy("ksize", "i").agg(F.sum("n").alias(out))
    shared = sides.select("ksize", "n", F.explode("l").alias("li"), "r").select("ksize", "n", "li", F.explode("r").alias("ri")).groupBy("ksize", "li", "ri").agg(F.sum("n").alias("n_shared"))
    every = counts.select("ksize").distinct().select("ksize", F.explode(F.array(*map(F.lit, left))).alias("li")).select("ksize", "li", F.explode(F.array(*map(F.lit, right))).alias("ri"))
    found = (
        every.join(size_of("l", "n_left").withColumnRenamed("i", "li"), ["ksize", "li"], "left")
        .join(size_of("r", "n_right").withColumnRenamed("i", "ri"), ["ksize", "ri"], "left")
        .join(shared, ["ksize", "li", "ri"], "left")
        .fillna(0, ["n_left", "n_right", "n_shared"])
        .where("n_left + n_right > 0")
    )
    return found.select(
        "ksize", F.get(name, F.col("li")).alias("left_set"), F.get(name, F.col("ri")).alias("right_set"), "n_left", "n_right", "n_shared",
        F.when(F.col("n_left") > 0, F.col("n_shared") / F.col("n_left")).alias("containment"),
    )


def coverage_by_all(counts: DataFrame, names: list[str], left: list[int], right: list[int]) -> DataFrame:
    """(ksize, left_set, n_left, n_known, n_novel): how many hashes of each left collection any right one has."""
    words = [c for c in counts.columns if c not in ("ksize", "n")]
    known = F.size(_members(words, right)) > 0
    each = counts.select("ksize", "n", known.alias("known"), F.explode(_members(words, left)).alias("li"))
    summed = each.groupBy("ksize", "li").agg(F.sum("n").alias("n_left"), F.sum(F.when(F.col("known"), F.col("n")).otherwise(0)).alias("n_known"))
    return summed.select("ksize", F.get(F.array(*map(F.lit, names)), F.col("li")).alias("left_set"), "n_left", "n_known", (F.col("n_left") - F.col("n_known")).alias("n_novel"))


def catalog_sets(spark: SparkSession, path: str, ksize: int | None = None) -> tuple[list[str], list[DataFrame], list[int], list[int]]:
    """(aliases, collections, numbers of the left ones, of the right ones) of a catalog file.

    A collection is the catalog table of its entry, or else the Parquet below the entry's path (a folder with the table's name in it comes first). One
    without a k column takes ``ksize``. The entries are read on the driver, the collections are not.
    """
    entries = listings.read_catalog(spark, path).collect()
    names, sets = [], []
    for e in entries:
        if e["ksize"] is None and ksize is None:
            raise ValueError(f"{e['alias']} has no k column: a ksize is needed")
        if "/" not in (e["path"] or "") and spark.catalog.tableExists(e["path"] or e["table"]):
            rows = spark.table(e["path"] or e["table"])
        else:
            rows = tables.read_hashes(spark, f"{e['path'].rstrip('/')}/{e['table']}")
        k = F.col(e["ksize"]) if e["ksize"] else F.lit(ksize)
        sets.append(rows.select(k.alias("ksize"), F.col(e["column"]).alias("hash")))
        names.append(e["alias"])
    side = lambda which: [i for i, e in enumerate(entries) if e["set_id"] == which]
    return names, sets, side("left"), side("right")


def compare_catalog(spark: SparkSession, path: str, ksize: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(overlaps of every left with every right collection of a catalog, coverage of every left one by all right ones), from one pass over the collections."""
    names, sets, left, right = catalog_sets(spark, path, ksize)
    if not left or not right:
        raise ValueError("a comparison needs a left and a right collection")
    counts = Scratch(spark, "masks").write(mask_counts(masks(sets)), "counts")
    return overlaps(counts, names, left, right), coverage_by_all(counts, names, left, right)
