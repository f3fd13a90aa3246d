"""Archives, listings and tables on small files."""

import gzip
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hashloom.operators.dedup import unique_hashes
from hashloom.sources import archives, listings, tables


def zipped(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in entries.items():
            z.writestr(name, data)


def rows(df):
    return sorted((r.sample_id, r.ksize, r.hash, r.bucket) for r in df.collect())


def test_layouts_and_faults(spark, tmp_path):
    big = 2**64 - 1
    zipped(
        tmp_path / "A.1.fna.sig.zip",
        {
            "a.sig": json.dumps({"ksize": 31, "mins": [1, 2**63]}),
            "b.json": json.dumps({"signatures": [{"ksize": "21", "hashes": [3]}, 7]}),
            "c.sig.gz": gzip.compress(json.dumps([{"mins": [4]}]).encode()),
            "d.JSON": json.dumps([{"signatures": [{"ksize": "x", "mins": [-1]}, {"ksize": 31, "mins": "no"}]}]),
            "e.sig.gz": b"not gzip",
            "f.json": b"{broken",
            "MANIFEST.csv": "x",
            "g.txt": json.dumps({"ksize": 1, "mins": [9]}),
        },
    )
    zipped(tmp_path / "B.sig.zip", {"a.sig": json.dumps([{"ksize": 31, "mins": [5, "six", 7]}, {"ksize": 31, "mins": [8]}])})
    (tmp_path / "C.sig.zip").write_bytes(b"not a zip")
    got = rows(archives.read_archives(spark, str(tmp_path)))
    assert got == sorted(
        [("A", 31, 1, 1), ("A", 31, -(2**63), 2**63 % 521), ("A", 21, 3, 3), ("A", 0, 4, 4), ("A", 0, -1, big % 521), ("B", 31, 5, 5)]
    )
    assert {r[1] for r in rows(archives.read_archives(spark, str(tmp_path), include_ksizes=[21]))} == {21}
    assert {r[0] for r in rows(archives.read_archives(spark, str(tmp_path), max_files=1))} == {"A"}
    with pytest.raises(PySparkException):
        archives.read_archives(spark, str(tmp_path), mode="failfast").count()


def test_damaged_archives(spark, tmp_path):
    """A bad gzip entry is skipped; a bad deflate stream, an encrypted entry, or Infinity ends the archive and keeps what stands before."""
    good = json.dumps({"ksize": 31, "mins": [1]})
    packed = bytearray(gzip.compress(json.dumps({"ksize": 31, "mins": list(range(500))}).encode()))
    packed[len(packed) // 2] ^= 0xFF
    zipped(tmp_path / "A.sig.zip", {"a.sig": good, "b.sig.gz": bytes(packed), "c.sig.gz": gzip.compress(good.encode())[:-9], "d.json": '{"ksize": Infinity, "mins": [2]}', "e.sig": '{"ksize": 31, "mins": [3, Infinity, 4]}', "f.sig": good})
    for name, kind in (("B", "deflate"), ("C", "encrypted")):
        with zipfile.ZipFile(tmp_path / f"{name}.sig.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("a.sig", good)
            z.writestr("b.sig", json.dumps({"ksize": 31, "mins": list(range(3000))}))
        data = bytearray((tmp_path / f"{name}.sig.zip").read_bytes())
        if kind == "deflate":
            at = data.index(b"b.sig")
            data[at + 5 : at + 25] = b"\xff" * 20
        else:  # the flag of the second entry, in its own header and in the directory
            for mark, flag in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
                data[data.rindex(mark) + flag] |= 1
        (tmp_path / f"{name}.sig.zip").write_bytes(bytes(data))
    assert rows(archives.read_archives(spark, str(tmp_path))) == [("A", 0, 2, 2), ("A", 31, 1, 1), ("A", 31, 3, 3), ("B", 31, 1, 1), ("C", 31, 1, 1)]
    for name in "ABC":
        with pytest.raises(PySparkException):
            archives.read_archives(spark, str(tmp_path), mode="failfast", pattern=f"{name}.sig.zip").count()


def test_globs(spark, tmp_path):
    for place in ("x/bucket=1", "x/bucket=2", "y"):
        (tmp_path / place).mkdir(parents=True)
        zipped(tmp_path / place / "S.sig.zip", {"a.sig": json.dumps({"ksize": 31, "mins": [1]})})
    n = lambda pattern: archives.scan_archives(spark, str(tmp_path), pattern=pattern).count()
    assert [n(x) for x in ("**/*.sig.zip", "bucket=*/*.sig.zip", "x/**/*.sig.zip", "y/S*", "S.sig.zip", "z/*")] == [3, 2, 2, 1, 3, 0]


def test_archive_sink(spark, occ, tmp_path):
    root = str(tmp_path / "sink")
    big = occ.unionByName(occ.limit(1).withColumn("hash", F.lit(-1).cast("long"))).select(F.lit("bucket=1").alias("dir"), F.col("sample_id").alias("name"), "ksize", "hash")
    for _ in range(2):  # again gives the same files
        written = archives.write_archives(big, root).collect()
    assert sorted(r.n_hashes for r in written) == [3, 3] and sorted(p.name for p in (tmp_path / "sink" / "bucket=1").iterdir()) == ["a.sig.zip", "b.sig.zip"]
    got = sorted((r.sample_id, r.ksize, r.hash) for r in archives.read_archives(spark, root, mode="failfast").collect())
    assert got == sorted((r.name, r.ksize, r.hash) for r in big.collect())


def test_ksize_out_of_range(spark, tmp_path):
    zipped(tmp_path / "A.sig.zip", {"a.sig": json.dumps({"ksize": 40000, "mins": [1]})})
    with pytest.raises(PySparkException):
        archives.read_archives(spark, str(tmp_path)).collect()


def test_sequences(spark, tmp_path):
    (tmp_path / "s.fa").write_text(">one\nACGT\nAC\n>two x\nTT\n")
    (tmp_path / "t.fna.gz").write_bytes(gzip.compress(b">three\nGG\n"))
    (tmp_path / "no.txt").write_text(">four\nGG\n")
    got = sorted((r.sample_id, r.header, r.sequence) for r in archives.read_fasta(spark, str(tmp_path)).collect())
    assert got == [("s", "one", "ACGTAC"), ("s", "two x", "TT"), ("t", "three", "GG")]
    assert [r.path.rsplit("/", 1)[1] for r in archives.scan_fasta(spark, str(tmp_path), 1).collect()] == ["s.fa"]
    (tmp_path / "p.tsv").write_text("id\tmid\tseq\np1\tx\tACG\n")
    assert [tuple(r) for r in archives.read_tsv_sequences(spark, str(tmp_path / "p.tsv")).collect()] == [("p1", "ACG")]


def test_file_list(spark, tmp_path):
    (tmp_path / "list.csv").write_text('b,k1.fa.gz,12,2024,md5,x\n"b","k2.fa.gz",abc,2024,,\nonly\nb,k3.txt,1,2024,,\nb,k4.fa.gz,,,,\n')
    got = [(r.filename, r.url, r["size"]) for r in listings.read_file_list(spark, str(tmp_path / "list.csv")).orderBy("filename").collect()]
    url = "https://b.s3.eu-west-2.amazonaws.com/"
    assert got == [("k1.fa.gz", url + "k1.fa.gz", 12), ("k2.fa.gz", url + "k2.fa.gz", None), ("k4.fa.gz", url + "k4.fa.gz", None)]
    assert listings.read_file_list(spark, str(tmp_path / "list.csv"), limit=1).count() == 1


def test_catalog_and_list_lines(spark, tmp_path):
    entry = {"name": "N", "alias": "n", "path": "/p", "table": "t", "column": "hash", "set_id": "left", "ksize": None}
    (tmp_path / "c.json").write_text(json.dumps({"databases": [entry, entry | {"set_id": "right", "ksize": "ksize"}]}, indent=1))
    assert [(r.set_id, r.ksize) for r in listings.read_catalog(spark, str(tmp_path / "c.json")).collect()] == [("left", None), ("right", "ksize")]
    lines = ["drwxr-xr-x 2 a b 4096 Jan 1 2020 sub dir", "-rw-r--r-- 1 a b 1 Jan 1 2020 f.fna", "lrwxrwxrwx 1 a b 1 Jan 1 2020 ln -> f", "drwxr-xr-x 2 a b 4096 Jan 1 2020 .", "bad"]
    got = listings.parse_list_lines(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert [tuple(r) for r in got] == [("sub dir", "dir"), ("f.fna", "file"), ("ln", "slink")]


@pytest.fixture
def occ(spark):
    data = [("a", 21, 5, 5), ("a", 31, 5, 5), ("b", 31, 5, 5), ("b", 31, 5, 5), ("b", 31, 600, 79)]
    return spark.createDataFrame(data, "sample_id string, ksize smallint, hash long, bucket int")


def test_dedup(occ):
    assert sorted(tuple(r) for r in unique_hashes(occ, True, True).collect()) == [(21, 5, 5, 1), (31, 5, 5, 2), (31, 600, 79, 1)]
    assert sorted(tuple(r) for r in unique_hashes(occ, False, True).collect()) == [(5, 5, 2), (600, 79, 1)]
    assert sorted(map(tuple, unique_hashes(occ.union(occ), False, False).collect())) == sorted(map(tuple, unique_hashes(occ, False, False).collect()))


def test_bucket_directories(spark, occ, tmp_path):
    raw, unique = str(tmp_path / "raw"), str(tmp_path / "unique")
    tables.write_occurrences(occ, raw, files_per_bucket=2)
    assert sorted(p.name for p in (tmp_path / "raw").iterdir() if p.is_dir()) == ["bucket=5", "bucket=79"]
    assert [r.bucket for r in tables.list_buckets(spark, raw).collect()] == [5, 79]
    tables.write_unique(unique_hashes(tables.read_hashes(spark, raw)), unique)
    tables.write_unique(unique_hashes(occ.where("bucket = 5 AND ksize = 21")), unique)
    got = sorted((r.ksize, r.hash) for r in tables.read_hashes(spark, unique).collect())
    assert got == [(21, 5), (31, 600)]
    with pytest.raises(tables.NoInputError):
        tables.read_hashes(spark, str(tmp_path / "nothing"))
    with pytest.raises(ValueError, match="compression"):
        tables.write_occurrences(occ, raw, compression="zip")


def test_foreign_unsigned_files(spark, tmp_path):
    table = pa.table({"HASH": pa.array([1, 2**63, 2**64 - 1], pa.uint64()), "bucket": pa.array([1, 2, 3], pa.int32())})
    pq.write_table(table, tmp_path / "u.parquet")
    got = tables.detected(spark.read.parquet(str(tmp_path))).collect()
    assert [tuple(r) for r in got] == [(1, 1), (-(2**63), 2), (-1, 3)]
    with pytest.raises(ValueError, match="missing"):
        tables.detected(spark.range(1))


def test_shards_keep_labels(spark, tmp_path):
    for part in ("000", "007", "12"):
        d = tmp_path / "k" / "ksize=31" / f"part={part}"
        d.mkdir(parents=True)
        pq.write_table(pa.table({"hash": pa.array([1], pa.uint64())}), d / "part.parquet")
    got = tables.read_shards(spark, str(tmp_path / "k"), ksize=5, with_part=True).collect()
    assert sorted(tuple(r) for r in got) == [(31, 1, "000"), (31, 1, "007"), (31, 1, "12")]
    flat = str(tmp_path / "k" / "ksize=31")
    assert {r.ksize for r in tables.read_shards(spark, flat, ksize=5).collect()} == {5}
    with pytest.raises(ValueError, match="ksize"):
        tables.read_shards(spark, flat)


def test_ingest_modes(spark, occ):
    tables.drop(spark, "loaded")
    unique = unique_hashes(occ, True, True)
    assert tables.ingest(unique, "loaded", "create", analyze=True) == 3
    with pytest.raises(ValueError, match="exists"):
        tables.ingest(unique, "loaded", "create")
    assert tables.ingest(unique.select(*reversed(unique.columns)), "loaded", "append") == 6
    assert tables.ingest(unique.where("ksize = 31"), "loaded", "replace") == 2
    with pytest.raises(PySparkException):
        tables.ingest(unique.withColumn("hash", F.lit(None).cast("long")), "loaded", "replace")
    assert spark.table("loaded").count() == 2
    tables.drop(spark, "loaded")


def test_bucketed_tables_join_without_exchange(spark, occ):
    from hashloom.operators.compare import novel

    for name in ("left_b", "right_b"):
        tables.drop(spark, name)
        tables.ingest(unique_hashes(occ), name, "create", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = novel(spark.table("left_b"), spark.table("right_b"))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    for name in ("left_b", "right_b"):
        tables.drop(spark, name)


def test_packed_archives_stream_over_batches(spark, monkeypatch):
    """A sample whose rows come in several batches is one archive, and tasks follow the bytes."""
    from hashloom import tasks
    from hashloom.plans import queries

    rows = spark.range(2000).selectExpr("cast(id % 11 as string) AS sample_id", "cast(id % 3 as smallint) AS ksize", "id AS hash")
    monkeypatch.setattr(tasks, "TASK_BYTES", 2000)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        packed = queries._packed(rows, lambda sample, by_k: (sample, repr({k: sorted(h) for k, h in by_k.items()}).encode()))
        assert packed.rdd.getNumPartitions() > 8
        got = {r.path: bytes(r.content).decode() for r in packed.collect()}
        assert packed.count() == 11
    finally:
        spark.conf.set(key, before)
    assert got == {str(s): repr({k: [i for i in range(2000) if i % 11 == s and i % 3 == k] for k in range(3)}) for s in range(11)}
