"""Walking directory trees that are given as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..scratch import Scratch

#: Names of sequence files, tried in this order.
SEQUENCE_PATTERNS = (
    r".*\.fna(\.(gz|bz2|xz|Z))?$",
    r".*\.fa(\.(gz|bz2|xz|Z))?$",
    r".*\.fasta(\.(gz|bz2|xz|Z))?$",
    r".*\.mfa(\.(gz|bz2|xz|Z))?$",
    r".*\.fsa_nt\.gz$",
    r".*_genomic\.fna(\.(gz|bz2|xz|Z))?$",
    r".*\.ffn(\.(gz|bz2|xz|Z))?$",
    r".*\.frn(\.(gz|bz2|xz|Z))?$",
)

#: Subtrees that are not walked.
SKIP_PREFIXES = (
    "/genomes/",
    "/genbank/wgs/",
    "/genbank/tsa/",
    "/genbank/tls/",
    "/sra/",
    "/geo",
    "/blast/windowmasker_files/",
)


def reachable(edges: DataFrame, roots: DataFrame, parent: str = "parent", child: str = "child", max_depth: int | None = None) -> DataFrame:
    """(node, depth) of every node at its least depth: a frontier moves on by joins, less what has been seen.

    Each level is written to the shared folder, so a level's plan doesn't grow with depth.
    """
    scratch = Scratch(edges.sparkSession, "reachable")
    steps = edges.select(F.col(parent).alias("_p"), F.col(child).alias("node"))
    frontier = roots.select(F.col(roots.columns[0]).alias("node")).distinct()
    seen = scratch.write(frontier.withColumn("depth", F.lit(0)), "level0")
    depth = 0
    while max_depth is None or depth < max_depth:
        depth += 1
        front = seen.where(F.col("depth") == depth - 1).select(F.col("node").alias("_p"))
        found = front.join(steps, "_p").select("node").distinct().join(seen.select("node"), "node", "left_anti")
        level = scratch.write(found.withColumn("depth", F.lit(depth)), f"level{depth}")
        if level.isEmpty():
            break
        seen = seen.unionByName(level)
    return seen


def crawl(pages: DataFrame, base: str, include: str, exclude: str | None = None, max_depth: int | None = None) -> DataFrame:
    """(subdir, filename, url, size, mtime) of target files in the listings of ``pages`` (dir relative to base with a final slash, empty for base itself; name; is_dir)."""
    inner = F.concat("dir", F.col("name"))
    edges = pages.where("is_dir").select(F.col("dir").alias("parent"), inner.alias("child"))
    roots = pages.sparkSession.createDataFrame([("",)], "node string")
    visited = reachable(edges, roots, max_depth=max_depth)
    files = pages.where(~F.col("is_dir")).join(visited, F.col("dir") == F.col("node"), "left_semi").where(names.is_target(F.col("name"), include, exclude))
    null = F.lit(None)
    return files.select(
        F.regexp_replace("dir", "/$", "").alias("subdir"), F.col("name").alias("filename"), F.concat(F.lit(base.rstrip("/") + "/"), inner).alias("url"), null.cast("bigint").alias("size"), null.cast("string").alias("mtime")
    ).distinct()


def walkable(path: Column, skip=SKIP_PREFIXES) -> Column:
    """Whether a path may be walked: no steps that lead back, no skipped prefix."""
    return ~names.is_suspicious(path) & ~names.has_prefix(path, skip)


def first_match(files: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """(group, value) of the first file of each group in the given order; groups are never gathered."""
    return files.groupBy(group).agg(F.min_by(value, F.struct(*order)).alias(value))


def subtree_examples(files: DataFrame, host: str, patterns=SEQUENCE_PATTERNS, skip=SKIP_PREFIXES, max_dirs: int | None = None, max_files: int | None = None) -> DataFrame:
    """(subtree, label, url): of each top-level subtree the first sequence file, directories before what lies below them, then by path.

    ``files``: absolute paths in the column path. With ``max_dirs`` or ``max_files`` only so many directories and
    files of a subtree are looked at, in that order.
    """
    ok = files.where(walkable(F.col("path"), skip)).withColumns(
        {
            "label": names.first_label(names.base_name(F.col("path")), [(p, p) for p in patterns]),
            "subtree": F.concat(F.lit("/"), F.split_part("path", F.lit("/"), F.lit(2)), F.lit("/")),
            "depth": F.size(F.split("path", "/")),
        }
    )
    if max_dirs is not None or max_files is not None:
        place = Window.partitionBy("subtree")
        ok = ok.withColumn("dir", F.regexp_replace("path", "[^/]*$", ""))
        if max_dirs is not None:
            ok = ok.withColumn("_d", F.dense_rank().over(place.orderBy("depth", "dir"))).where(F.col("_d") <= max_dirs)
        if max_files is not None:
            ok = ok.withColumn("_f", F.row_number().over(place.orderBy("depth", "path"))).where(F.col("_f") <= max_files)
    best = ok.where("label IS NOT NULL").groupBy("subtree").agg(F.min_by(F.struct("path", "label"), F.struct("depth", "path")).alias("m"))
    return best.select("subtree", "m.label", names.https_url(host, F.col("m.path")).alias("url"))
