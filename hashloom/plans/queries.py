"""The engine's operators as queries over the driver tables.

Roles: ``lineitem`` is a relation of hash occurrences (sample l_suppkey, k size
l_linenumber, hash l_partkey), ``documents`` are sequences (sample: source),
``events`` is a queue's log (user_id the file, event_type the status), ``pages``
are listings.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
import zipfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema, tasks
from ..functions import digests, names, uint64
from ..operators import compare, counting, dedup, sketch, traversal, workqueue
from ..scratch import Scratch, scratch_path
from ..sources import archive_source as archive_source_module
from ..sources import archives, listings, merged, tables
from ..streaming import incremental
from ..streaming import queue_timers as streamed_queue

MOD = 521
NOW = 1_750_000_000.0


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("sample_id"), F.col("l_linenumber").cast("smallint").alias("ksize"), F.col("l_partkey").alias("hash"))
    return hashed.withColumn("bucket", uint64.mod(F.col("hash"), MOD))


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue rows out of events: one file per event, its status by type, tries from its value."""
    e = load(spark, sf_dir, "events")
    kind = F.col("event_type")
    status = F.when(kind == "signup", "PENDING").when(kind == "error", "ERROR").when(kind == "click", "DOWNLOADING").when(kind == "view", "SKETCHING").otherwise("DONE")
    null = F.lit(None).cast("string")
    return e.select(
        F.col("event_id").alias("id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("subdir"), F.concat(F.lit("f"), F.col("event_id").cast("string"), F.lit(".fa.gz")).alias("filename"),
        F.concat(F.lit("https://host/"), F.col("event_id").cast("string")).alias("url"), F.lit(None).cast("bigint").alias("size"), null.alias("mtime"), status.alias("status"),
        F.pmod(F.col("event_id"), F.lit(25)).cast("int").alias("tries"), null.alias("last_error"), null.alias("out_path"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(NOW - F.pmod(F.col("event_id") * 37, F.lit(9000))).cast("double").alias("updated_at"), F.lit(0.0).alias("created_at"),
    )


def sketch_documents(spark, sf_dir):
    rows = sketch.sketch(load(spark, sf_dir, "documents"), "text", "source", (31,), 1000, "md5_60", mod=MOD)
    return dedup.unique_hashes(rows, by_ksize=True, with_counts=True)


def sketch_ksizes(spark, sf_dir):
    rows = sketch.sketch(load(spark, sf_dir, "documents"), "text", "source", (15, 31, 33), 1000, "md5_60", mod=MOD)
    return dedup.unique_hashes(rows, by_ksize=True).groupBy("ksize").agg(F.count(F.lit(1)).alias("n_hashes"), F.sum(F.col("hash") % 1_000_003).cast("bigint").alias("sum_hashes"))


def sketch_murmur(spark, sf_dir):
    rows = sketch.sketch(load(spark, sf_dir, "documents"), "text", "source", (21, 31), 200, "murmur3_64", mod=MOD)
    return dedup.unique_hashes(rows, by_ksize=True, with_counts=True)


def dedup_ksize_hash(spark, sf_dir):
    return dedup.unique_hashes(occurrences(spark, sf_dir), True, False)


def dedup_hash(spark, sf_dir):
    return dedup.unique_hashes(occurrences(spark, sf_dir), False, False)


def dedup_ksize_hash_counts(spark, sf_dir):
    return dedup.unique_hashes(occurrences(spark, sf_dir), True, True)


def dedup_hash_counts(spark, sf_dir):
    return dedup.unique_hashes(occurrences(spark, sf_dir), False, True)


def incremental_counts(spark, sf_dir):
    """Counts of distinct samples after three loads, one a return flag."""
    counts = counting.SampleCounts(spark, scratch_path(spark, "counts"))
    rows = load(spark, sf_dir, "lineitem")
    for flag in ("A", "N", "R"):
        part = rows.where(F.col("l_returnflag") == flag).select(F.col("l_suppkey").alias("sample_id"), F.col("l_linenumber").cast("smallint").alias("ksize"), F.col("l_partkey").alias("hash"))
        counts.load(part.withColumn("bucket", uint64.mod(F.col("hash"), MOD)), flag)
    return counts.counts()


def bucket_histogram(spark, sf_dir):
    return dedup.bucket_histogram(occurrences(spark, sf_dir))


def filter_ksizes(spark, sf_dir):
    return dedup.keep_ksizes(occurrences(spark, sf_dir), (2, 4)).groupBy("ksize").agg(F.count(F.lit(1)).alias("n_rows"))


def ingest_detect(spark, sf_dir):
    with_counts = dedup.unique_hashes(occurrences(spark, sf_dir), True, True)
    return tables.detected(with_counts.withColumnRenamed("hash", "HASH"))


def union_by_name(spark, sf_dir):
    o = occurrences(spark, sf_dir)
    plain = dedup.unique_hashes(o.where("ksize <= 3"), True, False)
    counted = dedup.unique_hashes(o.where("ksize > 3"), True, True)
    merged = plain.unionByName(counted, allowMissingColumns=True)
    return merged.select("ksize", "hash", "bucket", F.coalesce("n_samples", F.lit(-1)).alias("n_samples"))


def merged_files(spark, sf_dir):
    """Files with and without n_samples under one root, read back as one relation."""
    root = scratch_path(spark, "merged")
    o = occurrences(spark, sf_dir)
    dedup.unique_hashes(o.where("ksize <= 3"), True, False).write.parquet(f"{root}/a")
    dedup.unique_hashes(o.where("ksize > 3"), True, True).write.parquet(f"{root}/b")
    merged = spark.read.option("mergeSchema", True).parquet(f"{root}/a", f"{root}/b")
    return tables.detected(merged).groupBy("bucket").agg(F.count(F.lit(1)).alias("n_rows"), F.count("n_samples").alias("n_counted"), F.coalesce(F.sum("n_samples"), F.lit(0)).cast("bigint").alias("sum_samples"))


def bucket_tables(spark, sf_dir):
    """Occurrences written to bucket directories, deduplicated per bucket, written and read again."""
    raw, unique = scratch_path(spark, "occurrences"), scratch_path(spark, "unique")
    tables.write_occurrences(occurrences(spark, sf_dir), raw)
    tables.write_unique(dedup.unique_hashes(tables.read_hashes(spark, raw), True, True), unique)
    return tables.detected(tables.read_hashes(spark, unique))


def merged_buckets(spark, sf_dir):
    """Two collections' sorted bucket files merged to their distinct hashes without a sort or an exchange."""
    one, two = scratch_path(spark, "one"), scratch_path(spark, "two")
    o, flag = load(spark, sf_dir, "lineitem"), F.col("l_returnflag") == "R"
    for root, rows in ((one, o.where(flag)), (two, o.where(~flag))):
        hashed = rows.select(F.col("l_linenumber").cast("smallint").alias("ksize"), F.col("l_partkey").alias("hash"))
        tables.write_unique(dedup.unique_hashes(hashed.withColumn("bucket", uint64.mod(F.col("hash"), MOD)), True, False), root)
    return merged.read_merged(spark, one, two)


def folded_tables(spark, sf_dir):
    """Hashes that a table of 64 buckets has and one of 8 has too, met bucket by bucket."""
    o = load(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_linenumber").cast("smallint").alias("ksize"), F.col("l_partkey").alias("hash"))
    left, right = (f"{side}_{uuid.uuid4().hex}" for side in ("fine", "coarse"))
    tables.ingest(o.where("l_returnflag = 'R'").select("ksize", "hash").distinct(), left, "create", buckets=64)
    tables.ingest(o.where("l_returnflag <> 'R'").select("ksize", "hash").distinct(), right, "create", buckets=8)
    with compare.folded_buckets(spark):
        found = Scratch(spark, "folded").write(compare.known(spark.table(left), spark.table(right)), "known")
    tables.drop(spark, left)
    tables.drop(spark, right)
    return found


def list_buckets(spark, sf_dir):
    root = scratch_path(spark, "listed")
    tables.write_occurrences(occurrences(spark, sf_dir), root)
    return tables.list_buckets(spark, root)


def wgs_shards(spark, sf_dir):
    """Shards with labels such as 007 and 35b, whose text survives."""
    root = scratch_path(spark, "shards")
    part = F.concat(F.lpad(F.pmod("hash", F.lit(11)).cast("string"), 3, "0"), F.when(F.col("hash") % 3 == 0, "b").otherwise(""))
    dedup.unique_hashes(occurrences(spark, sf_dir), False).select("hash", F.lit(31).alias("ksize"), part.alias("part")).write.partitionBy("ksize", "part").parquet(root)
    return tables.read_shards(spark, root, with_part=True).groupBy("ksize", "part").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("hash") % 1_000_003).cast("bigint").alias("sum_hashes"))


def append_loads(spark, sf_dir):
    """Two appends of one load: rows double, distinct hashes don't."""
    root = scratch_path(spark, "appended")
    unique = dedup.unique_hashes(occurrences(spark, sf_dir), True, False)
    for _ in range(2):
        unique.write.mode("append").parquet(root)
    got = spark.read.parquet(root)
    return got.groupBy("ksize").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("hash").alias("n_hashes"))


#: Bytes of archives that a worker gives away at once.
PACKED_BYTES = 4 << 20


def _packed(rows, pack):
    """(path, content) of one archive a sample, ``pack(sample, {k size: hashes})``. Rows are dealt and sorted by sample and stream through, so a worker holds one sample's hashes and a few archives."""

    def run(batches):
        out, held, sample, by_k = [], 0, None, {}

        def given():
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([c for _, c in out], pa.binary())], ["path", "content"])

        def ended():
            path, content = pack(sample, {k: np.concatenate(parts).tolist() for k, parts in by_k.items()})
            out.append((path, content))
            return len(content)

        for batch in batches:
            samples = batch.column(0).dictionary_encode(null_encoding="encode")
            codes, ksizes, hashes = samples.indices.to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (ksizes[1:] != ksizes[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, len(codes)], strict=True):
                if start == end:
                    continue
                name = samples.dictionary[int(codes[start])].as_py()
                if by_k and name != sample:
                    held += ended()
                    by_k = {}
                    if held >= PACKED_BYTES:
                        yield given()
                        out, held = [], 0
                sample = name
                by_k.setdefault(int(ksizes[start]), []).append(hashes[start:end])
        if by_k:
            ended()
        if out:
            yield given()

    dealt = tasks.dealt(rows.select("sample_id", "ksize", "hash"), "sample_id").sortWithinPartitions("sample_id", "ksize")
    return dealt.mapInArrow(run, "path string, content binary")


def archive_rows(spark, sf_dir):
    """Sketch archives made of lineitem, one per supplier and with every accepted layout, decoded again."""

    def pack(sample, by_k):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            for k, hashes in sorted(by_k.items()):
                signature = {"ksize": str(k) if k % 2 else k, ("mins" if k % 3 else "hashes"): hashes}
                layout = [signature, {"signatures": [signature]}, [signature], [{"class": "x", "signatures": [signature]}]][k % 4]
                z.writestr(f"signatures/{k}.sig", json.dumps(layout))
            z.writestr("MANIFEST.csv", "ignored")
        return f"/data/{sample}.1_x.fna.gz.sig.zip", buffer.getvalue()

    o = occurrences(spark, sf_dir)
    return dedup.unique_hashes(archives.decode_archives(_packed(o, pack), MOD), True, True, n_tasks=tasks.needed(o))


def archive_faults(spark, sf_dir):
    """Archives with damaged entries, values and ends, one per supplier: what stands before a fault is decoded."""

    def entry(k, hashes, more=""):
        return f'{{"ksize": {k}, "mins": [{", ".join(map(str, hashes))}{more}]}}'

    def pack(sample, found):
        by_k = {k: found.get(k, []) for k in range(1, 8)}
        buffer, n = io.BytesIO(), int(sample)
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("a.sig", entry(1, by_k[1]))
            packed = gzip.compress(entry(2, by_k[2]).encode())
            z.writestr("b.sig.gz", packed if n % 2 else packed[: len(packed) // 2])
            z.writestr("c.json", entry(3, by_k[3])[:-1])
            z.writestr("d.json", entry("Infinity", by_k[4]))
            z.writestr("e.sig", entry(5, by_k[5], "" if n % 3 else ", Infinity" if by_k[5] else "Infinity"))
            z.writestr("f.sig", entry(6, by_k[6]))
        return f"/data/{sample}.sig.zip", buffer.getvalue() if n % 5 else buffer.getvalue()[:-22]

    found = archives.decode_archives(_packed(occurrences(spark, sf_dir), pack), MOD)
    return found.groupBy("ksize").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sample_id").alias("n_samples"), F.sum("hash").alias("sum_hashes"))


def archive_sink(spark, sf_dir):
    """Occurrences written as archives, one per supplier, and read again."""
    root = scratch_path(spark, "sigzips")
    o = occurrences(spark, sf_dir)
    archives.write_archives(o.select(F.lit("").alias("dir"), F.col("sample_id").alias("name"), "ksize", "hash"), root)
    return dedup.unique_hashes(archives.read_archives(spark, root, MOD, mode="failfast"), True, True, n_tasks=tasks.needed(o))


def archive_source(spark, sf_dir):
    """The same archives by the data source, each k size asked for."""
    root = scratch_path(spark, "sigzips")
    o = occurrences(spark, sf_dir)
    archives.write_archives(o.select(F.lit("").alias("dir"), F.col("sample_id").alias("name"), "ksize", "hash"), root)
    found = archive_source_module.stream_archives(spark, root, MOD, mode="failfast")
    return dedup.unique_hashes(found.where("ksize IN (2, 3, 5, 7)"), True, True, n_tasks=tasks.needed(o))


def tsv_sequences(spark, sf_dir):
    """First and last column of tab-separated files with a header row."""
    root = scratch_path(spark, "tsv")
    load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand", F.replace("p_name", F.lit(" "), F.lit("")).alias("seq")).write.option("sep", "\t").option("header", True).csv(root)
    return archives.read_tsv_sequences(spark, root)


def list_lines(spark, sf_dir):
    """Lines of a Unix directory listing made of suppliers."""
    mode = F.element_at(F.array(F.lit("drwxr-xr-x"), F.lit("lrwxrwxrwx"), F.lit("-rw-r--r--")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    tail = F.when(F.col("s_suppkey") % 3 == 1, " -> /target").otherwise("")
    line = F.concat(mode, F.lit(" 2 ftp anonymous 4096 Jan  1  2020 "), F.replace("s_name", F.lit("#"), F.lit(" ")), tail)
    return listings.parse_list_lines(load(spark, sf_dir, "supplier").select(line.alias("line")))


def catalog_rows(spark, sf_dir):
    """A catalog of collections written as JSON and read again."""
    root = scratch_path(spark, "catalog")
    side = F.when(F.col("n_nationkey") % 2 == 0, "left").otherwise("right")
    n = load(spark, sf_dir, "nation").select(
        F.struct(F.col("n_name").alias("name"), F.lower("n_name").alias("alias"), F.concat(F.lit("/db/"), "n_name").alias("path"), F.lit("unique_hashes").alias("table"), F.lit("hash").alias("column"),
                 side.alias("set_id"), F.when(F.col("n_nationkey") % 2 == 1, "ksize").alias("ksize")).alias("d"), F.lit(0).alias("one")
    )
    n.groupBy("one").agg(F.collect_list("d").alias("databases")).select("databases").write.json(root)
    return listings.read_catalog(spark, root)


def ingest_modes(spark, sf_dir):
    """The total rows that a catalog table has after each load: created, appended to, replaced."""
    unique = dedup.unique_hashes(occurrences(spark, sf_dir), True, True)
    table = f"loaded_{uuid.uuid4().hex}"
    found = []
    for mode, rows in (("create", unique), ("append", unique.where("ksize <= 3")), ("replace", unique.where("ksize = 2"))):
        found.append((mode, tables.ingest(rows, table, mode, analyze=mode == "replace")))
    tables.drop(spark, table)
    return spark.createDataFrame(found, "mode string, n_rows long")


def ingest_statistics(spark, sf_dir):
    """What the catalog knows of a loaded table's columns."""
    table = f"analysed_{uuid.uuid4().hex}"
    tables.ingest(dedup.unique_hashes(occurrences(spark, sf_dir), True, True), table, "create", analyze=True)
    found = tables.column_statistics(spark, table, ["ksize", "hash", "bucket", "n_samples"])
    tables.drop(spark, table)
    return found


def index_probe(spark, sf_dir):
    """All order keys asked at once of an indexed table of the part keys' hashes."""
    table, index = f"indexed_{uuid.uuid4().hex}", scratch_path(spark, "index")
    tables.ingest(dedup.unique_hashes(occurrences(spark, sf_dir), True, True), table, "create", index=index)
    return tables.probe(load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("hash")), table, index)


def shards_ksize(spark, sf_dir):
    """Shards without a k size in their path take the one given."""
    root = scratch_path(spark, "flat")
    part = F.lpad(F.pmod("hash", F.lit(7)).cast("string"), 3, "0")
    dedup.unique_hashes(occurrences(spark, sf_dir), False).select("hash", part.alias("part")).write.partitionBy("part").parquet(root)
    return tables.read_shards(spark, root, ksize=21, with_part=True).groupBy("ksize", "part").agg(F.count(F.lit(1)).alias("n_rows"))


def _worker_round(spark, sf_dir):
    """One round of the worker loop: outputs that are there are taken, one file in five fails at each of three attempts, one in seven gives no result."""
    state = queue(spark, sf_dir)

    def work(todo):
        out = F.concat(F.lit("/out/"), F.col("filename"))
        return todo.where("id % 7 <> 0").select("id", out.alias("out_path"), F.when(F.col("id") % 5 == 0, "broken").alias("error"))

    done = state.where("id % 11 = 0").select("subdir", "filename", F.lit("/old").alias("out_path"))
    return workqueue.run_batch(state, 400, NOW, work, done, attempts=3)


def queue_worker(spark, sf_dir):
    return _worker_round(spark, sf_dir)[0].select("id", "status", "tries", "out_path", "last_error")


def queue_worker_counts(spark, sf_dir):
    """The counts of the same round, with the first errors."""
    return _worker_round(spark, sf_dir)[1].select("outcome", "n", F.array_join("examples", ",").alias("examples"))


def queue_claim_errors(spark, sf_dir):
    """A claim from a queue whose PENDING rows are all done: the ERROR rows that have cooled down, the longest waiting first."""
    state = queue(spark, sf_dir)
    null = F.lit(None).cast("string")
    finished = state.where("status = 'PENDING'").select("id", F.lit("DONE").alias("status"), null.alias("out_path"), null.alias("last_error"), F.lit(False).alias("inc_tries"))
    return workqueue.claim(workqueue.mark(state, finished, NOW), 400, NOW)[0].select("id", "subdir", "filename")


def queue_store(spark, sf_dir):
    """A stored queue: stuck rows are taken back, three claimers take 200 rows each, the second one's fail; the state after it."""
    store = workqueue.QueueStore(spark, scratch_path(spark, "queue"))
    store.start(queue(spark, sf_dir))
    store.reset_stuck(NOW)
    claims = [store.claim(200, NOW + k) for k in range(3)]
    failed = claims[1].select("id", F.lit("ERROR").alias("status"), F.lit(None).cast("string").alias("out_path"), F.lit("lost").alias("last_error"), F.lit(True).alias("inc_tries"))
    store.mark(failed, NOW + 9)
    return store.state().select("id", "status", "tries", "last_error", "updated_at")


def crawl_queue(spark, sf_dir):
    """Listings of three levels walked from the root, and the target files added to a queue that knows some of them."""
    c, n = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    region = F.concat(F.lit("r"), F.col("n_regionkey"), F.lit("/"))
    nation = F.concat(region, F.lit("n"), F.col("n_nationkey"), F.lit("/"))
    r = load(spark, sf_dir, "region").select(F.lit("").alias("dir"), F.concat(F.lit("r"), "r_regionkey", F.lit("/")).alias("name"), F.lit(True).alias("is_dir"))
    d = n.select(region.alias("dir"), F.concat(F.lit("n"), "n_nationkey", F.lit("/")).alias("name"), F.lit(True).alias("is_dir"))
    f = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(nation.alias("dir"), F.concat(F.lit("c"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"), F.when(F.col("c_custkey") % 3 == 0, ".txt").otherwise(".fna.gz")).alias("name"), F.lit(False).alias("is_dir"))
    files = traversal.crawl(r.union(d).union(f), "https://host/all", r".*\.fna\.gz$", r"c0*1\.")
    known = files.where("filename < 'c000000050'").withColumn("url", F.lit("old"))
    state = workqueue.upsert(spark.createDataFrame([], schema.QUEUE), known, NOW - 9)
    return workqueue.upsert(state, files, NOW).select("id", "subdir", "filename", "url", "status", "updated_at", "created_at")


def infer_sample_id(spark, sf_dir):
    raw = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("/in/GCA_"), F.col("p_partkey").cast("string"), F.lit(".2_"), F.replace("p_name", F.lit(" "), F.lit("_")), F.when(F.col("p_size") % 2 == 0, "_genomic.fna.gz.sig.zip").otherwise(".FASTA.SIG.ZIP")).alias("path"))
    return raw.select("id", names.sample_id(F.col("path")).alias("sample_id"))


def _shards(kind, n):
    def run(spark, sf_dir):
        url = load(spark, sf_dir, "pages").select("page_id", "url")
        return url.select("page_id", digests.shard(F.col("url"), n, kind).alias("shard"), digests.shard_dir(F.col("url"), n, kind).alias("dir"))

    return run


def u64_mod(spark, sf_dir):
    h = load(spark, sf_dir, "customer").select("c_custkey", uint64.from_hex(F.substring(F.md5("c_name"), 1, 16)).alias("h"))
    return h.select("c_custkey", uint64.mod(F.col("h"), 521).alias("m521"), uint64.mod(F.col("h"), 512).alias("m512"), uint64.mod(F.col("h"), 64).alias("m64"), uint64.to_string(F.col("h")).alias("value"))


def u64_wrap(spark, sf_dir):
    v = load(spark, sf_dir, "orders").select("o_orderkey", (F.lit("9223372036854775807").cast("decimal(38,0)") * (F.col("o_orderkey") % 5 - 2) + F.col("o_orderkey")).alias("v"))
    return v.select("o_orderkey", uint64.to_string(uint64.wrap(F.col("v"))).alias("value"))


def hrefs(spark, sf_dir):
    return load(spark, sf_dir, "pages").select("page_id", F.explode(names.hrefs(F.col("html"))).alias("href")).groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


def hrefs_relative(spark, sf_dir):
    links = F.transform(names.hrefs(F.col("html")), lambda x: F.ltrim(x, F.lit("/")))
    return load(spark, sf_dir, "pages").select("page_id", F.explode(names.listing_entries(links)).alias("name")).groupBy("page_id", "name").agg(F.count(F.lit(1)).alias("n"))


def target_pages(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    path = F.regexp_replace("url", "^https?://[^/]*", "")
    return p.where(names.is_target(path, "[0-9]+", ".*7")).select("page_id", names.base_name(path).alias("name"))


def path_rules(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    prefix = F.element_at(F.array(*(F.lit(x) for x in ("/genomes/", "/geo", "/pub/", "/sra/", "/refseq/./", "/blast/"))), (F.col("doc_id") % 6 + 1).cast("int"))
    end = F.element_at(F.array(*(F.lit(x) for x in ("a.fna.gz", "B.FA", "c.txt", "d_genomic.fna", "e.fsa_nt.gz"))), (F.col("doc_id") % 5 + 1).cast("int"))
    path = F.concat(prefix, F.col("source"), F.lit("/"), end)
    labels = [(p, p) for p in traversal.SEQUENCE_PATTERNS]
    return d.select("doc_id", traversal.walkable(path).alias("walkable"), names.first_label(names.base_name(path), labels).alias("label"))


def subtree_examples(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    path = F.concat(F.lit("/"), F.col("source"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/"), F.col("lang"))).otherwise(""), F.lit("/seq "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, "~.fna.gz").otherwise(".txt"))
    return traversal.subtree_examples(d.select(path.alias("path")), "host.example").select("subtree", "url")


def quoted_urls(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", names.quoted_path(F.concat("p_type", F.lit("/~a*b+c/"), "p_name")).alias("quoted"))


def _bucket_listing(spark, sf_dir):
    """A bucket's listing made of pages, with quoted fields, missing keys, other files and sizes that are no numbers."""
    p = load(spark, sf_dir, "pages")
    return p.select(
        F.lit('"bucket-a"').alias("bucket"),
        F.when(F.col("page_id") % 9 == 0, F.lit(None)).otherwise(F.concat(F.lit(' "k'), F.col("page_id").cast("string"), F.when(F.col("page_id") % 4 == 0, ".txt").otherwise(".fa.gz"), F.lit('"'))).alias("key"),
        F.when(F.col("page_id") % 5 == 0, "n/a").otherwise(F.length("html").cast("string")).alias("size"),
        F.lit("2024-01-01T00:00:00Z").alias("modified"),
    )


def file_list(spark, sf_dir):
    return listings.file_list_rows(_bucket_listing(spark, sf_dir), "eu-west-2", ".fa.gz").withColumn("size", F.coalesce("size", F.lit(-1)))


def first_files(spark, sf_dir):
    """The cap of a test run: the first fifty files that stay, in the order of their keys."""
    return listings.file_list_rows(_bucket_listing(spark, sf_dir), "eu-west-2", ".fa.gz", limit=50).select("filename", "url")


def file_list_queue(spark, sf_dir):
    """A bucket listing as rows of a new queue."""
    files = listings.file_list_rows(_bucket_listing(spark, sf_dir), "eu-west-2", ".fa.gz")
    return workqueue.upsert(spark.createDataFrame([], schema.QUEUE), files, NOW).select("id", "subdir", "filename", "url", F.coalesce("size", F.lit(-1)).alias("size"), "mtime", "status", "tries", "created_at")


def fasta_files(spark, sf_dir):
    """Sequence files found below a root, among others, by their names' endings in any case."""
    root = scratch_path(spark, "fasta")
    end = F.element_at(F.array(*map(F.lit, (".fa", ".FNA", ".fasta.gz", ".txt", ".fa.bak", ".Fa.gz"))), (F.col("s_suppkey") % 6 + 1).cast("int"))
    place = F.concat(F.lit("n"), F.col("s_nationkey"), F.lit("/s"), F.col("s_suppkey"), end)

    def write(batches):
        store, base = archives.opened(root)
        for pdf in batches:
            for name, text in zip(pdf["name"], pdf["text"], strict=True):
                store.create_dir(f"{base}/{name.rsplit('/', 1)[0]}", recursive=True)
                with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                    out.write(text.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    files = load(spark, sf_dir, "supplier").select(place.alias("name"), F.col("s_name").alias("text")).repartition("name")
    Scratch(spark, "fasta_names").write(files.mapInPandas(write, "n long"), "written")
    found = archives.scan_fasta(spark, root)
    return found.select(F.regexp_extract("path", "(n[0-9]+/[^/]*)$", 1).alias("name"), F.col("length").cast("long").alias("length"))


def subtree_report(spark, sf_dir):
    """The lines of the report of the first file of each subtree."""
    root = scratch_path(spark, "report")
    tables.write_tsv(subtree_examples(spark, sf_dir), root)
    return spark.read.text(root).select(F.col("value").alias("line"))


def queue_pending_work(spark, sf_dir):
    return workqueue.pending_work(queue(spark, sf_dir))


def crawl_depth(spark, sf_dir):
    n, c = load(spark, sf_dir, "nation"), load(spark, sf_dir, "customer")
    first = load(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("child"), F.lit("root").alias("parent"))
    second = n.select(F.concat(F.lit("n"), "n_nationkey").alias("child"), F.concat(F.lit("r"), "n_regionkey").alias("parent"))
    third = c.select(F.concat(F.lit("c"), "c_custkey").alias("child"), F.concat(F.lit("n"), "c_nationkey").alias("parent"))
    back = n.select(F.concat(F.lit("r"), "n_regionkey").alias("child"), F.concat(F.lit("n"), "n_nationkey").alias("parent"))
    edges = first.union(second).union(third).union(back)
    return traversal.reachable(edges, spark.createDataFrame([("root",)], "node string")).groupBy("depth").agg(F.count(F.lit(1)).alias("n_nodes"))


def queue_stats(spark, sf_dir):
    return workqueue.stats(queue(spark, sf_dir))


def queue_latest_state(spark, sf_dir):
    return workqueue.latest(load(spark, sf_dir, "events"), ["user_id"], F.col("ts").desc(), F.col("event_id").desc()).select("user_id", "event_id", "event_type")


def queue_claim(spark, sf_dir):
    return workqueue.claim(queue(spark, sf_dir), 400, NOW)[0].select("id", "subdir", "filename")


def queue_timers(spark, sf_dir):
    """A user's events as one file's, streamed: the rows in progress for over a day are taken back, errors older than an hour can be claimed."""
    root = scratch_path(spark, "timers")
    kind = F.col("event_type")
    status = F.when(kind == "signup", "PENDING").when(kind == "error", "ERROR").when(kind == "click", "DOWNLOADING").when(kind == "view", "SKETCHING").otherwise("DONE")
    e = spark.readStream.schema(load(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    events = e.select(F.concat(F.lit("u"), "user_id").alias("subdir"), F.lit("f").alias("filename"), F.col("event_id").alias("id"), F.concat(F.lit("https://host/"), "event_id").alias("url"), status.alias("status"),
                      F.pmod(F.col("event_id"), F.lit(25)).cast("int").alias("tries"), F.col("ts").alias("at"))
    changes = streamed_queue.queue_changes(events, stale=86_400, cooldown=3600)
    streamed_queue.run_changes(changes, f"{root}/changes", f"{root}/checkpoint")
    found = streamed_queue.queue_rows(spark.read.parquet(f"{root}/changes"))
    return found.select("subdir", "id", "status", "tries", "claimable")


def queue_requeue(spark, sf_dir):
    return workqueue.reset_stuck(queue(spark, sf_dir), NOW).select("id", "status", "tries", "updated_at")


def queue_upsert(spark, sf_dir):
    state = queue(spark, sf_dir)
    found = state.where("id % 3 = 0").select("subdir", "filename", F.concat("url", F.lit("?v=2")).alias("url"), F.col("id").alias("size"), F.lit("m").alias("mtime"))
    fresh = load(spark, sf_dir, "pages").select(F.lit("p").alias("subdir"), F.concat(F.lit("page"), F.lpad(F.col("page_id").cast("string"), 9, "0")).alias("filename"), "url", F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("mtime"))
    return workqueue.upsert(state, found.union(fresh), NOW).select("id", "subdir", "filename", "url", F.coalesce("size", F.lit(-1)).alias("size"), "mtime", "status", "tries")


def queue_mark(spark, sf_dir):
    state = queue(spark, sf_dir)
    changes = state.where("status = 'SKETCHING'").select("id", F.when(F.col("id") % 2 == 0, "DONE").otherwise("ERROR").alias("status"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("/out/"), F.col("filename"))).alias("out_path"), F.when(F.col("id") % 2 == 1, "failed").alias("last_error"), (F.col("id") % 2 == 1).alias("inc_tries"))
    return workqueue.mark(state, changes, NOW).select("id", "status", "tries", "out_path", "last_error")


def queue_verify(spark, sf_dir):
    state = queue(spark, sf_dir)
    probes = state.where("id % 4 <> 3").select("url", F.when(F.col("id") % 4 == 0, 404).otherwise(200).alias("code"))
    return workqueue.verify(state, probes, NOW).select("id", "status", "tries", "last_error")


def queue_unfinished(spark, sf_dir):
    return workqueue.unfinished(queue(spark, sf_dir), 100)


def queue_next_batch(spark, sf_dir):
    return workqueue.next_batch(queue(spark, sf_dir), 200, after=100)


def even_chunks(spark, sf_dir):
    return dedup.even_chunks(load(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7).groupBy("worker").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


def backoff(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("int").alias("tries")).distinct().select("tries", names.backoff_seconds(F.col("tries")).alias("seconds"))


def rna_to_dna(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(names.rna_to_dna(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")))).alias("digest"))


def _sides(spark, sf_dir):
    """The left side, written, and what the right one has of its hashes: no comparison asks for more, and so the others are neither grouped nor written."""
    scratch = Scratch(spark, "sides")
    left = sketch.sketch(load(spark, sf_dir, "benchmark").withColumn("name", F.lit("benchmark")), "text", "name", (31,), 20, "md5_60", mod=MOD)
    left = scratch.write(compare.normalised(left), "left")
    right = sketch.sketch(load(spark, sf_dir, "documents"), "text", "source", (31,), 20, "md5_60", mod=MOD)
    return left, compare.known(right, left)


def known_hashes(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return compare.known(left, compare.normalised(right))


def novel_hashes(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return compare.novel(left, compare.normalised(right, ksize_col=None, ksize=31))


def containment(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return compare.containment(left, compare.normalised(right))


def cross_catalog_coverage(spark, sf_dir):
    left, right = _sides(spark, sf_dir)
    return compare.coverage(left, right.select("sample_id", "ksize", "hash").distinct(), "sample_id")


def _catalog(spark, sf_dir):
    """A catalog of seven collections, one a return flag and line status and one of all urgent orders, each written as a table of hashes; two are left ones."""
    root = scratch_path(spark, "collections")
    kind = F.lower(F.concat("l_returnflag", "l_linestatus"))
    lines = load(spark, sf_dir, "lineitem").select(kind.alias("kind"), F.col("l_linenumber").cast("smallint").alias("ksize"), F.col("l_partkey").alias("hash"), "l_orderkey")
    urgent = lines.join(load(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    sets = {k: lines.where(F.col("kind") == k) for k in ("af", "ao", "nf", "no", "rf", "ro")} | {"urgent": urgent}
    for name, rows in sets.items():
        rows.select("ksize", "hash").distinct().write.parquet(f"{root}/{name}/unique_hashes")
    entries = [(n, n, f"{root}/{n}", "unique_hashes", "hash", "left" if n in ("ro", "urgent") else "right", "ksize") for n in sets]
    spark.createDataFrame([(entries,)], schema.CATALOG).coalesce(1).write.json(f"{root}/catalog")
    return f"{root}/catalog"


def catalog_overlaps(spark, sf_dir):
    """Every left collection of a catalog with every right one."""
    return compare.compare_catalog(spark, _catalog(spark, sf_dir))[0]


def catalog_coverage(spark, sf_dir):
    """What all right collections of a catalog know of each left one."""
    return compare.compare_catalog(spark, _catalog(spark, sf_dir))[1]


def point_lookup(spark, sf_dir):
    return tables.lookup(occurrences(spark, sf_dir), 42, MOD).groupBy("ksize").agg(F.count_distinct("sample_id").alias("n_samples"))


def stream_dedup(spark, sf_dir):
    schema = load(spark, sf_dir, "lineitem").schema
    stream = incremental.occurrence_stream(spark, sf_dir, schema, glob="lineitem.parquet").select(F.col("l_linenumber").cast("smallint").alias("ksize"), F.col("l_partkey").alias("hash"))
    out = scratch_path(spark, "stream")
    incremental.run_available(incremental.dedup_stream(stream, mod=MOD), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


NAMES = (
    "sketch_documents sketch_ksizes sketch_murmur dedup_ksize_hash dedup_hash dedup_ksize_hash_counts dedup_hash_counts incremental_counts bucket_histogram filter_ksizes"
    " ingest_detect union_by_name merged_files bucket_tables merged_buckets folded_tables list_buckets wgs_shards append_loads archive_rows archive_faults archive_sink archive_source tsv_sequences list_lines catalog_rows ingest_modes ingest_statistics index_probe shards_ksize queue_worker queue_worker_counts queue_claim_errors queue_store crawl_queue infer_sample_id u64_mod u64_wrap hrefs hrefs_relative"
    " target_pages path_rules subtree_examples quoted_urls file_list first_files file_list_queue fasta_files subtree_report queue_pending_work crawl_depth queue_stats queue_latest_state queue_claim queue_timers queue_requeue queue_upsert queue_mark"
    " queue_verify queue_unfinished queue_next_batch even_chunks backoff rna_to_dna known_hashes novel_hashes containment cross_catalog_coverage catalog_overlaps catalog_coverage point_lookup stream_dedup"
)
QUERIES = {n: globals()[n] for n in NAMES.split()} | {"shard_md5": _shards("md5", 4096), "shard_sha1": _shards("sha1", 4096), "shard_sha256": _shards("sha256", 512)}
