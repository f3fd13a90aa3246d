"""Command line: ``python -m hashloom <command> ...`` (or spark-submit with this file).

Session settings (cores, memory, shuffle partitions) come from spark-submit or
spark-defaults; the programs set none.
"""

from __future__ import annotations

import argparse
import json
import sys
import time

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from . import schema
from .functions import digests, names
from .operators import compare, dedup, sketch, sketch_files, traversal, workqueue
from .scratch import Scratch
from .sources import archives, listings, tables

EXIT_ERRORS, EXIT_NO_INPUT = 2, 1


def _numbers(text: str) -> list[int]:
    """Whole numbers of a comma-separated list; others are left out."""
    return [int(x) for x in text.split(",") if x.strip().lstrip("-").isdigit()]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="hashloom")
    sub = top.add_subparsers(dest="command", required=True)

    p = sub.add_parser("export", help="sketch archives to bucket directories of hash occurrences")
    p.add_argument("--input-root", required=True)
    p.add_argument("--out-root", required=True)
    p.add_argument("--glob", default="**/*.sig.zip")
    p.add_argument("--collection", choices=sorted(schema.PRESETS), help="defaults of a known collection")
    p.add_argument("--mod", type=int)
    p.add_argument("--compression", default="zstd", choices=tables.CODECS)
    p.add_argument("--max-files", type=int, default=0)
    p.add_argument("--include-ksizes", default="")
    p.add_argument("--files-per-bucket", type=int, default=0)
    p.add_argument("--fail-fast", action="store_true")

    p = sub.add_parser("dedup", help="distinct hashes per bucket")
    p.add_argument("--non-dedup-root", required=True)
    p.add_argument("--out-root", required=True)
    p.add_argument("--with-counts", action="store_true")
    p.add_argument("--by-ksize", action="store_true")
    p.add_argument("--collection", choices=sorted(schema.PRESETS), help="--with-counts and --by-ksize as a known collection has them")
    p.add_argument("--files-per-bucket", type=int, default=0)
    p.add_argument("--max-buckets", type=int, default=0)

    p = sub.add_parser("ingest", help="distinct hashes to a catalog table")
    p.add_argument("--dedup-root", required=True)
    p.add_argument("--pattern", default="bucket=*/*.parquet")
    p.add_argument("--table", default="unique_hashes")
    p.add_argument("--mode", default="replace", choices=("replace", "append", "create"))
    p.add_argument("--buckets", type=int, default=0)
    p.add_argument("--no-sort", action="store_true")
    p.add_argument("--analyze", action="store_true")
    p.add_argument("--index", help="folder for a hash index of the files")

    p = sub.add_parser("probe", help="rows of a table, loaded with --index, that have one of many hashes")
    p.add_argument("--table", default="unique_hashes")
    p.add_argument("--index", required=True)
    p.add_argument("--hashes", required=True, help="Parquet with a column hash")
    p.add_argument("--out", required=True)

    p = sub.add_parser("compare", help="left collections of a catalog against all right ones")
    p.add_argument("--catalog", required=True, help="JSON file of the collections")
    p.add_argument("--ksize", type=int, help="of collections without a k column")
    p.add_argument("--out", required=True, help="folder for overlaps and coverage")

    p = sub.add_parser("ingest-shards", help="pre-deduplicated shards to a catalog table")
    p.add_argument("--parquet-root", required=True)
    p.add_argument("--pattern", default="")
    p.add_argument("--table", default="wgs_hashes")
    p.add_argument("--mode", default="replace", choices=("replace", "append", "create"))
    p.add_argument("--ksize", type=int)
    p.add_argument("--with-part", action="store_true")
    p.add_argument("--no-sort", action="store_true")
    p.add_argument("--analyze", action="store_true")

    p = sub.add_parser("sketch", help="sequence files to hash occurrences")
    p.add_argument("-i", "--input-root", required=True)
    p.add_argument("-o", "--out-root", required=True)
    p.add_argument("--collection", choices=sorted(schema.PRESETS), help="k sizes and modulus of a known collection")
    p.add_argument("--archives", action="store_true", help="an archive for each file instead of bucket directories")
    p.add_argument("--force", action="store_true", help="archives that are there are made anew")
    p.add_argument("--ksizes")
    p.add_argument("--scaled", type=int, default=1000)
    p.add_argument("--mod", type=int)
    p.add_argument("--rna", action="store_true", help="U as T")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--max-files", type=int, default=0)
    p.add_argument("--n-shards", type=int, default=4096)

    p = sub.add_parser("find", help="first sequence file of each subtree of a listing of paths")
    p.add_argument("--paths", required=True, help="text file, one absolute path a line")
    p.add_argument("--host", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--include", action="append", default=[])
    p.add_argument("--skip-prefix", action="append", default=[])
    p.add_argument("--no-default-skips", action="store_true")
    p.add_argument("--max-dirs", type=int, help="directories looked at in a subtree")
    p.add_argument("--max-files", type=int, help="files looked at in a subtree")

    p = sub.add_parser("enqueue", help="a bucket listing to queue rows")
    p.add_argument("--file-list", required=True)
    p.add_argument("--state", required=True)
    p.add_argument("--out-state", required=True)
    p.add_argument("--region", default="eu-west-2")
    p.add_argument("--include-suffix", default=".fa.gz")
    p.add_argument("--limit", type=int)
    p.add_argument("--now", type=float, required=True)

    p = sub.add_parser("crawl", help="target files of directory listings to queue rows")
    p.add_argument("--pages", required=True, help="Parquet of the listings: url, html")
    p.add_argument("--base-url", required=True)
    p.add_argument("--include-regex", default=r".*\.fna\.gz$")
    p.add_argument("--exclude-regex")
    p.add_argument("--max-depth", type=int)
    p.add_argument("--smoke-test-limit", type=int)
    p.add_argument("--dry-run", action="store_true", help="print the URLs only")
    p.add_argument("--state", help="queue to go on from; none for a new one")
    p.add_argument("--out-state", required=True)
    p.add_argument("--now", type=float, required=True)

    p = sub.add_parser("work", help="sketch the queue's files, which a mirror holds, until none can be claimed")
    p.add_argument("--state", required=True)
    p.add_argument("--out-state", required=True, help="folder that keeps the state; one that has a state goes on from it, and several programs may share it")
    p.add_argument("--mirror", required=True, help="folder with <subdir>/<filename> of every file")
    p.add_argument("--out-root", required=True)
    p.add_argument("--collection", choices=sorted(schema.PRESETS))
    p.add_argument("--ksizes")
    p.add_argument("--scaled", type=int, default=1000)
    p.add_argument("--n-shards", type=int, default=512)
    p.add_argument("--batch", type=int, default=10_000)
    p.add_argument("--max-retries", type=int, default=6)
    p.add_argument("--cooldown", type=float, default=1800)
    p.add_argument("--max-total-tries", type=int, default=20)
    p.add_argument("--stale", type=float, default=3600)

    p = sub.add_parser("queue-stats", help="rows by status, as JSON")
    p.add_argument("--state", required=True)
    return top


def preset(a, name: str, default):
    """A setting: as given, else of the collection, else the default."""
    given = getattr(a, name, None)
    if given:
        return _numbers(given) if name == "ksizes" else given
    of = schema.PRESETS[a.collection][name] if a.collection else None
    return default if of is None else of


def export(spark: SparkSession, a) -> int:
    mode = "failfast" if a.fail_fast else "permissive"
    files = archives.scan_archives(spark, a.input_root, a.max_files, a.glob)
    n_files = files.select("path").count()
    if not n_files:
        print("no input files found", file=sys.stderr)
        return 0
    seen = Observation("rows")
    rows = archives.decode_archives(files, preset(a, "mod", 521), _numbers(a.include_ksizes), mode).observe(seen, F.count(F.lit(1)).alias("n"))
    tables.write_occurrences(rows, a.out_root, a.compression, a.files_per_bucket)
    print(f"files={n_files} rows={seen.get['n']}")
    return 0


def run_dedup(spark: SparkSession, a) -> int:
    rows = tables.read_hashes(spark, a.non_dedup_root)
    if a.max_buckets:
        first = [r["bucket"] for r in tables.list_buckets(spark, a.non_dedup_root).limit(a.max_buckets).collect()]
        rows = rows.where(F.col("bucket").isin(first))
    unique = dedup.unique_hashes(rows, preset(a, "by_ksize", False), preset(a, "with_counts", False))
    tables.write_unique(unique, a.out_root, files_per_bucket=a.files_per_bucket)
    return 0


def ingest(spark: SparkSession, a) -> int:
    found = tables.detected(tables.read_hashes(spark, a.dedup_root, pattern=a.pattern))
    print(tables.ingest(found, a.table, a.mode, not a.no_sort, a.buckets, a.analyze, a.index))
    return 0


def probe(spark: SparkSession, a) -> int:
    tables.probe(tables.inner_form(spark.read.parquet(a.hashes)), a.table, a.index).write.mode("error").parquet(a.out)
    return 0


def run_compare(spark: SparkSession, a) -> int:
    overlaps, coverage = compare.compare_catalog(spark, a.catalog, a.ksize)
    overlaps.write.mode("error").parquet(f"{a.out}/overlaps")
    coverage.write.mode("error").parquet(f"{a.out}/coverage")
    return 0


def ingest_shards(spark: SparkSession, a) -> int:
    found = tables.read_shards(spark, a.parquet_root, a.ksize, a.with_part, a.pattern)
    print(tables.ingest(found, a.table, a.mode, not a.no_sort, 0, a.analyze))
    return 0


def run_sketch(spark: SparkSession, a) -> int:
    files = archives.scan_fasta(spark, a.input_root, a.max_files)
    if files.isEmpty():
        print("no input files found", file=sys.stderr)
        return EXIT_NO_INPUT
    if a.dry_run:
        for r in files.select("path", digests.shard_dir(names.base_name(F.col("path")), a.n_shards).alias("shard")).toLocalIterator():
            print(r["path"], r["shard"], sep="\t")
        return 0
    ksizes = preset(a, "ksizes", (15, 31, 33))
    if a.archives:
        done = sketch_files.sketch_to_archives(files, a.out_root, ksizes, a.scaled, a.rna, a.n_shards, force=a.force)
        return report(Scratch(spark, "sketch").write(done, "done"))
    rows = archives.read_fasta(spark, a.input_root)
    if a.max_files:
        rows = rows.join(files.select(names.sample_id(F.col("path")).alias("sample_id")).distinct(), "sample_id", "left_semi")
    if a.rna:
        rows = rows.withColumn("sequence", names.rna_to_dna(F.col("sequence")))
    found = sketch.sketch(rows, "sequence", "sample_id", ksizes, a.scaled, "murmur3_64", dna=True, mod=preset(a, "mod", 521)).distinct()
    tables.write_occurrences(found, a.out_root)
    return 0


def report(done) -> int:
    """Prints the counts of sketched files, and up to EXAMPLES errors; the exit code."""
    error = F.col("error").isNotNull()
    n = done.agg(F.count_if(~error & ~F.col("skipped")).alias("done"), F.count_if("skipped").alias("skipped"), F.count_if(error).alias("error")).first().asDict()
    print(json.dumps(n))
    for r in done.where(error).orderBy("path").limit(workqueue.EXAMPLES).collect():
        print(f"{r['path']}: {r['error'].splitlines()[0]}", file=sys.stderr)
    return EXIT_ERRORS if n["error"] else 0


def find(spark: SparkSession, a) -> int:
    paths = spark.read.text(a.paths).select(F.trim("value").alias("path"))
    skip = [*(() if a.no_default_skips else traversal.SKIP_PREFIXES), *a.skip_prefix]
    tables.write_tsv(traversal.subtree_examples(paths, a.host, [*traversal.SEQUENCE_PATTERNS, *a.include], skip, a.max_dirs, a.max_files), a.out)
    return 0


def enqueue(spark: SparkSession, a) -> int:
    files = listings.read_file_list(spark, a.file_list, a.region, a.include_suffix, a.limit)
    state = workqueue.read_state(spark, a.state)
    workqueue.upsert(workqueue.reset_stuck(state, a.now), files, a.now).write.mode("error").parquet(a.out_state)
    return 0


def crawl(spark: SparkSession, a) -> int:
    base = a.base_url.rstrip("/") + "/"
    links = listings.listing_links(spark.read.parquet(a.pages).where(F.col("url").startswith(base)))
    pages = links.withColumn("dir", F.substring(F.concat(F.regexp_replace("dir", "/*$", ""), F.lit("/")), len(base) + 1, 1 << 20))
    files = traversal.crawl(pages, base, a.include_regex, a.exclude_regex, a.max_depth)
    if a.smoke_test_limit:
        files = files.orderBy("subdir", "filename").limit(a.smoke_test_limit)
    if a.dry_run:
        for r in files.orderBy("url").toLocalIterator():
            print(r["url"])
        return 0
    state = workqueue.read_state(spark, a.state) if a.state else spark.createDataFrame([], schema.QUEUE)
    workqueue.upsert(state, files, a.now).write.mode("error").parquet(a.out_state)
    return 0


def work(spark: SparkSession, a) -> int:
    state = workqueue.read_state(spark, a.state)
    ksizes = preset(a, "ksizes", (15, 31, 33))

    def sketched(todo):
        place = F.concat_ws("/", F.lit(a.mirror.rstrip("/")), F.when(F.col("subdir") != "", F.col("subdir")), F.col("filename"))
        files = todo.select("id", place.alias("path"))
        return sketch_files.sketch_to_archives(files.select("path"), a.out_root, ksizes, a.scaled, n_shards=a.n_shards).join(files, "path").select("id", "out_path", "error")

    _, totals = workqueue.run_queue(state, a.out_state, a.batch, sketched, cooldown=a.cooldown, cap=a.max_total_tries, attempts=a.max_retries + 1, stale=a.stale)
    print(json.dumps(totals))
    return EXIT_ERRORS if totals["error"] else 0


def queue_stats(spark: SparkSession, a) -> int:
    counts = {r["status"]: r["n"] for r in workqueue.stats(workqueue.read_state(spark, a.state)).collect()}
    print(json.dumps({"total": counts.pop("total", 0), "by_status": counts}))
    return 0


COMMANDS = {
    "export": export, "dedup": run_dedup, "ingest": ingest, "probe": probe, "compare": run_compare, "ingest-shards": ingest_shards,
    "sketch": run_sketch, "find": find, "enqueue": enqueue, "crawl": crawl, "work": work, "queue-stats": queue_stats,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return COMMANDS[a.command](spark or SparkSession.builder.appName(f"hashloom {a.command}").getOrCreate(), a)
    except tables.NoInputError as e:
        print(e, file=sys.stderr)
        return EXIT_ERRORS


if __name__ == "__main__":
    sys.exit(main())
