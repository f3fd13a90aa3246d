"""A hash index over the files of a table, and probes of many hashes at once.

The index has a manifest, one row a file (rows, least and largest hash, bitmap blocks), and the blocks of a blocked Bloom filter:
a hash belongs to one block of a file and sets ``BITS`` of the block's 32,768 bits. A probe meets the manifest first (by
the leading bits of the hash, then by the file's range), then the blocks, and only the files that are left are opened. A hash that
isn't in a table opens a file about once in a hundred times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from .versions import VersionedTable

#: Bits of a block, bits that a hash sets, and hashes that a block is made for.
BLOCK_BITS, BITS, PER_BLOCK = 32_768, 4, 3_000
#: Leading bits of a hash that a probe and a file meet on.
CELL_BITS = 12
#: Files up to which the manifest is broadcast, pairs of hash and file up to which these are, and files up to which their names are pushed into the scan of the blocks.
BROADCAST_FILES, BROADCAST_ASKED, PUSHED_FILES = 50_000, 500_000, 500


def _cell(h: Column) -> Column:
    return F.shiftright(h, 64 - CELL_BITS)


def _mixed(h: Column) -> Column:
    return F.xxhash64(h)


def _block(h: Column, blocks: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(_mixed(h), 32), blocks)


def _positions(h: Column) -> Column:
    """The bits that a hash sets in its block."""
    low, high = F.shiftrightunsigned(_mixed(h), 8).bitwiseAND(F.lit(0x7FFF)), F.xxhash64(h, F.lit(1))
    step = F.shiftrightunsigned(high, 8).bitwiseAND(F.lit(0x7FFF)).bitwiseOR(F.lit(1))
    return F.array(*((low + step * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(BITS)))


def _bit(bitmap: Column, position: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def build_index(rows: DataFrame, root: str, hash_col: str = "hash") -> None:
    """Writes the index of the files that ``rows`` (a plain read of Parquet files) comes from, as versions below root.

    Two scans of the hash column: one for the manifest, one for the bitmaps, both pre-aggregated a task. Null
    hashes are left out. The versions of an index that is there stay until vacuum.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "index")
    found = rows.select(F.col("_metadata.file_path").alias("file"), F.col(hash_col).cast("long").alias("h")).where("h IS NOT NULL")
    manifest = found.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    manifest = scratch.write(manifest.withColumn("blocks", F.ceil(F.col("n_rows") / PER_BLOCK).cast("long")), "manifest")
    small = F.broadcast(manifest) if manifest.count() <= BROADCAST_FILES else manifest.hint("merge")
    set_bits = found.join(small.select("file", "blocks"), "file").select("file", _block(F.col("h"), F.col("blocks")).alias("block"), F.explode(_positions(F.col("h"))).alias("at"))
    bitmaps = set_bits.groupBy("file", "block").agg(F.bitmap_construct_agg(F.col("at")).alias("bitmap"))
    # in the order of the files, so that row-group statistics prune what a probe reads of them
    VersionedTable(spark, f"{root}/blocks").replace(scratch.write(bitmaps, "bitmaps").repartitionByRange("file", "block").sortWithinPartitions("file", "block"))
    VersionedTable(spark, f"{root}/manifest").replace(manifest)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """(file, n_rows, lo, hi, blocks) of every file of the index."""
    return VersionedTable(spark, f"{root}/manifest").read()


def candidates(hashes: DataFrame, root: str, hash_col: str = "hash") -> DataFrame:
    """(h, file): the files that may hold each distinct hash; no file that does is missing."""
    spark = hashes.sparkSession
    asked = hashes.select(F.col(hash_col).cast("long").alias("h")).where("h IS NOT NULL").distinct()
    # a file stands under every cell that its range touches; sorted files touch one or two
    files = manifest(spark, root).withColumn("cell", F.explode(F.sequence(_cell(F.col("lo")), _cell(F.col("hi")))))
    near = asked.withColumn("cell", _cell(F.col("h"))).join(files, "cell").where("h BETWEEN lo AND hi").select("h", "file", _block(F.col("h"), F.col("blocks")).alias("block"))
    near = Scratch(spark, "near").write(near, "near")
    blocks = VersionedTable(spark, f"{root}/blocks").read()
    few = near.select("file").distinct().limit(PUSHED_FILES + 1).collect()
    if len(few) <= PUSHED_FILES:
        blocks = blocks.where(F.col("file").isin([r["file"] for r in few]))
    # the bits are looked at where the bitmap is: it isn't moved unless the asked are too many to go to it
    asking = F.broadcast(near) if near.count() <= BROADCAST_ASKED else near.hint("merge")
    held = blocks.join(asking, ["file", "block"]).where(F.forall(_positions(F.col("h")), lambda at: _bit(F.col("bitmap"), at)))
    return held.select("h", "file")


def probe(hashes: DataFrame, root: str, hash_col: str = "hash") -> DataFrame:
    """``opened`` without the list of files."""
    return opened(hashes, root, hash_col)[0]


def opened(hashes: DataFrame, root: str, hash_col: str = "hash") -> tuple[DataFrame, list[str]]:
    """(the rows of the indexed table whose hash is among ``hashes``, all columns; the files that they are read from).

    What goes through the driver is the names of the files to open, never more than the manifest has. A probe that no file can
    answer opens none. Repeated and null hashes among the asked count once and not at all.
    """
    spark = hashes.sparkSession
    scratch = Scratch(spark, "probe")
    wanted = scratch.write(candidates(hashes, root, hash_col), "candidates")
    files = [r["file"] for r in wanted.select("file").distinct().collect()]
    listed = manifest(spark, root).select("file").first()
    if listed is None:
        raise ValueError(f"the index {root} has no file")
    table = spark.read.parquet(*files) if files else spark.read.parquet(listed["file"]).where(F.lit(False))
    return table.join(wanted.select(F.col("h").alias(hash_col)).distinct(), hash_col, "left_semi"), files
