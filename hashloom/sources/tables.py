"""Hash tables at rest: bucket directories, schema-detecting loads, partitioned and sorted tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import uint64
from . import hash_index

#: What stands between a table's name and a version's number.
VERSION = "__v"
CODECS = ("zstd", "snappy", "gzip", "brotli", "lz4", "none")


class NoInputError(ValueError):
    """No file of the pattern is there."""


def write_occurrences(df: DataFrame, root: str, compression: str = "zstd", files_per_bucket: int = 0, mode: str = "append") -> None:
    """``bucket=<n>`` directories (numbers unpadded) of hash-dealt files; one shuffle, so a file has one bucket.

    Without ``files_per_bucket`` adaptive execution makes a large bucket several files and tasks; with it, a bucket has so many by a hash of the hash.
    """
    if compression not in CODECS:
        raise ValueError(f"compression is one of {CODECS}")
    _by_bucket(df, files_per_bucket).write.partitionBy("bucket").option("compression", compression).mode(mode).parquet(root)


def _by_bucket(df: DataFrame, files_per_bucket: int) -> DataFrame:
    if files_per_bucket > 0:
        return df.repartition("bucket", F.pmod(F.xxhash64("hash"), F.lit(files_per_bucket)))
    return df.hint("rebalance", "bucket")


def write_unique(df: DataFrame, root: str, compression: str = "zstd", files_per_bucket: int = 0) -> None:
    """Sorted files in bucket directories (one each unless a bucket is large); only the buckets that ``df`` has are replaced."""
    keys = [c for c in ("ksize", "hash") if c in df.columns]
    dealt = _by_bucket(df, files_per_bucket).sortWithinPartitions("bucket", *keys)
    dealt.write.partitionBy("bucket").option("compression", compression).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(root)


def list_buckets(spark: SparkSession, root: str) -> DataFrame:
    """(bucket) of the directories ``bucket=<int>`` under root, sorted; from file names alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    number = F.regexp_extract("path", r"/bucket=([0-9]+)/", 1)
    return files.select(F.expr("try_cast(regexp_extract(path, '/bucket=([0-9]+)/', 1) AS int)").alias("bucket")).where(number != "").distinct().orderBy("bucket")


def read_hashes(spark: SparkSession, root: str, merge: bool = True, pattern: str = "") -> DataFrame:
    """Occurrences or distinct hashes under a root of bucket directories, or in the files below it that match a glob; unlike files merge by name, unsigned columns come in their inner form."""
    reader = spark.read.option("mergeSchema", merge).option("basePath", root)
    return inner_form(_existing(reader, f"{root.rstrip('/')}/{pattern}" if pattern else root))


def _existing(reader, *paths: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return reader.parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NoInputError(f"no Parquet files under {', '.join(paths)}") from e
        raise


def inner_form(df: DataFrame) -> DataFrame:
    """``df`` with a DECIMAL hash column (foreign UINT_64) as BIGINT of the same bits."""
    for f in df.schema:
        if f.name.lower() == "hash" and f.dataType.typeName() == "decimal":
            df = df.withColumn(f.name, uint64.from_decimal(F.col(f.name)))
    return df


def detected(df: DataFrame) -> DataFrame:
    """The columns of a table of distinct hashes that ``df`` has, typed: [ksize], hash, bucket, [n_samples]."""
    have = {c.lower(): c for c in df.columns}
    types = {"ksize": "smallint", "hash": "bigint", "bucket": "int", "n_samples": "bigint"}
    missing = {"hash", "bucket"} - set(have)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    return inner_form(df).select(*(F.col(have[c]).cast(t).alias(c) for c, t in types.items() if c in have))


def read_shards(spark: SparkSession, root: str, ksize: int | None = None, with_part: bool = False, pattern: str = "") -> DataFrame:
    """ksize, hash[, part] of ``[ksize=<k>/]part=<label>`` directories.

    Labels stay text (``000`` and ``35b`` alike). A k size in the path wins
    over ``ksize``; with neither an error is raised.
    """
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        df = inner_form(_existing(spark.read.option("basePath", root), f"{root.rstrip('/')}/{pattern}" if pattern else root))
    finally:
        spark.conf.set(key, before)
    have = {c.lower(): c for c in df.columns}
    if "ksize" in have:
        k: Column = F.col(have["ksize"]).cast("smallint")
    elif ksize is not None:
        k = F.lit(ksize).cast("smallint")
    else:
        raise ValueError("no ksize in the path and none given")
    columns = [k.alias("ksize"), F.col(have["hash"]).cast("bigint").alias("hash")]
    if with_part:
        if "part" not in have:
            raise ValueError("no part in the path")
        columns.append(F.col(have["part"]).cast("string").alias("part"))
    return df.select(*columns)


def current(spark: SparkSession, table: str) -> str | None:
    """The version that the name ``table`` points at: the catalog table behind it, or None if there is no such name."""
    if not spark.catalog.tableExists(table):
        return None
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    found = re.fullmatch(rf"SELECT \* FROM (\S*{VERSION}[0-9a-f]{{32}})", told.get("View Text", ""))
    if found is None:
        raise ValueError(f"{table} is no table of this loader (which names a view over the newest version)")
    return found[1]


def _write_version(df: DataFrame, version: str, buckets: int, keys: list[str], mode: str = "error") -> None:
    w = df.write.format("parquet")
    if buckets:
        w = w.bucketBy(buckets, *keys).sortBy(*keys)
    w.option("parquet.bloom.filter.enabled#hash", "true").mode(mode).saveAsTable(version)


def _point(spark: SparkSession, table: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")


def _drop_version(spark: SparkSession, version: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {version}")


def ingest(df: DataFrame, table: str, mode: str = "replace", sort: bool = True, buckets: int = 0, analyze: bool = False, index: str | None = None) -> int:
    """Loads ``df`` under a catalog name and returns the total rows there.

    The name is a view, the pointer to the newest version, a table that is written whole before the view names it. Changing
    the view is one step of the catalog. So a failure anywhere leaves the old rows or the new ones; what a failed load has left beside is removed by it or, if it couldn't, by ``sweep``.

    ``create``: an error if the name is there. ``replace``: a new version; the old one goes after the view has changed. ``append``: more rows by name
    in the current version; made if missing; rows are not deduplicated. Null hashes raise. ``sort`` orders
    files by (ksize, hash), so that row-group statistics prune lookups;
    ``buckets`` > 0 deals the table by (ksize, hash) for joins without a shuffle. ``index``: a folder for a hash index of the version's files (see ``hash_index``);
    it is made before the view changes, and anew for the files of an append.
    """
    spark = df.sparkSession
    if mode not in ("replace", "append", "create"):
        raise ValueError("mode is 'replace', 'append' or 'create'")
    keys = [c for c in ("ksize", "hash") if c in df.columns]
    was = current(spark, table)
    if mode == "create" and was:
        raise ValueError(f"table {table} exists")
    checked = df.withColumn("hash", F.when(F.col("hash").isNull(), F.raise_error(F.lit("null hash"))).otherwise(F.col("hash")))
    if buckets:
        checked = checked.repartition(buckets, *keys)  # as the buckets are dealt, so that each is one sorted file
    elif sort:
        checked = checked.repartitionByRange(*keys).sortWithinPartitions(*keys)
    if mode == "append" and was:
        _write_version(checked.select(*spark.table(was).columns), was, buckets, keys, "append")
        _finish(spark, was, analyze, index)
        return spark.table(table).count()
    version = f"{table}{VERSION}{uuid.uuid4().hex}"
    try:
        _write_version(checked, version, buckets, keys)
        _finish(spark, version, analyze, index)
        _point(spark, table, version)
    except BaseException:
        if current(spark, table) != version:
            _drop_version(spark, version)
        raise
    if was:
        _drop_version(spark, was)
    return spark.table(table).count()


def _finish(spark: SparkSession, version: str, analyze: bool, index: str | None) -> None:
    if analyze:
        spark.sql(f"ANALYZE TABLE {version} COMPUTE STATISTICS FOR ALL COLUMNS")
    if index:
        hash_index.build_index(spark.table(version), index_root(version, index))


def index_root(version: str, index: str) -> str:
    return f"{index.rstrip('/')}/{version.split('.')[-1]}"


def probe(hashes: DataFrame, table: str, index: str) -> DataFrame:
    """Rows of a table, loaded with ``index``, whose hash is among ``hashes``; only the files that can hold one are opened."""
    version = current(hashes.sparkSession, table)
    if version is None:
        raise ValueError(f"no table {table}")
    return hash_index.probe(hashes, index_root(version, index))


def sweep(spark: SparkSession, table: str) -> int:
    """Drops the versions of a table that its name doesn't point at (nobody may be loading it meanwhile); how many."""
    now, name = current(spark, table), table.split(".")[-1]
    database = table.rpartition(".")[0]
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES {f'IN {database} ' if database else ''}LIKE '{name}{VERSION}*'").collect()]
    gone = [f"{database}.{v}" if database else v for v in found if now is None or v != now.split(".")[-1]]
    for v in gone:
        _drop_version(spark, v)
    return len(gone)


def drop(spark: SparkSession, table: str) -> None:
    """Removes a name and its version; nothing if there is none."""
    version = current(spark, table)
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    if version:
        _drop_version(spark, version)


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """(column, lo, hi, n_null) that the catalog holds of an analysed table; values as text, null where it holds none."""
    version, found = current(spark, table), []
    for c in columns:
        told = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {version} {c}").collect()}
        found.append((c, *(None if told.get(k) in (None, "NULL") else told[k] for k in ("min", "max", "num_nulls"))))
    return spark.createDataFrame(found, "column string, lo string, hi string, n_null string")


def lookup(df: DataFrame, value: int, mod: int, ksize: int | None = None) -> DataFrame:
    """Rows of one hash; the bucket derived from it prunes directories, the hash row groups."""
    if not 0 <= value < 1 << 64:
        raise ValueError("a hash is in [0, 2**64)")
    found = df.where((F.col("bucket") == value % mod) & (F.col("hash") == (value - (1 << 64) if value >> 63 else value)))
    return found if ksize is None else found.where(F.col("ksize") == ksize)


def write_tsv(df: DataFrame, path: str) -> None:
    """One tab-separated file of the columns subtree and url, sorted, after the line ``#subtree<tab>url``: a short report."""
    lines = df.orderBy("subtree").select(F.concat_ws("\t", "subtree", "url").alias("value"))
    head = df.sparkSession.createDataFrame([("#subtree\turl",)], "value string")
    head.coalesce(1).unionByName(lines.coalesce(1)).coalesce(1).write.mode("overwrite").text(path)
