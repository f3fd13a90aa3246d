"""File lists, directory listings and the catalog of collections as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import names


def read_file_list(spark: SparkSession, path: str, region: str = "eu-west-2", include_suffix: str = ".fa.gz", limit: int | None = None) -> DataFrame:
    """(subdir, filename, url, size, mtime) of the rows of a bucket listing whose key has the suffix.

    Rows of fewer than two fields and others go first; the limit counts rows that stay, in the order of their keys.
    """
    rows = spark.read.schema(schema.FILE_LIST).csv(path)
    return file_list_rows(rows, region, include_suffix, limit)


def file_list_rows(rows: DataFrame, region: str, include_suffix: str, limit: int | None = None) -> DataFrame:
    def bare(c: str) -> Column:
        return F.btrim(F.trim(F.col(c)), F.lit('"'))

    kept = rows.where(F.col("key").isNotNull()).select(bare("bucket").alias("b"), bare("key").alias("filename"), "size", bare("modified").alias("mtime")).where(F.col("filename").endswith(include_suffix))
    out = kept.select(F.lit("").alias("subdir"), "filename", names.s3_url(F.col("b"), F.col("filename"), region).alias("url"), names.size_or_null(F.col("size")).alias("size"), "mtime")
    return out if limit is None else out.orderBy("filename").limit(limit)


def listing_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(dir, name, is_dir): a directory page's own entries."""
    found = pages.select(F.col(url_col).alias("dir"), F.explode(names.listing_entries(names.hrefs(F.col(html_col)))).alias("name"))
    return found.select("dir", "name", F.col("name").endswith("/").alias("is_dir"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row per collection: name, alias, path, table, column, set_id (left or right), ksize (name of the k column or null)."""
    return spark.read.schema(schema.CATALOG).option("multiLine", True).json(path).select(F.inline("databases"))


def parse_list_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    """(name, kind) of the lines of a Unix directory listing; kind is dir, slink or file."""
    line = F.col(col)
    mode = F.substring(line, 1, 1)
    name = F.regexp_extract(line, r"^(?:\S+\s+){8}(.*)$", 1)
    kind = F.when(mode == "d", "dir").when(mode == "l", "slink").otherwise("file")
    return lines.select(F.when(mode == "l", F.substring_index(name, " -> ", 1)).otherwise(name).alias("name"), kind.alias("kind")).where(~F.col("name").isin("", ".", ".."))
