"""The archive data source: streamed reading against whole reading, commit and abort of the writer."""

import gzip
import io
import json
import os
import random
import time
import zipfile

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hashloom.sources import archive_source, archives


def make(path, entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)


def hostile(root):
    """Archives with every layout, order of fields, odd spacing, damaged entries and values that are no numbers."""
    rng = random.Random(1)
    many = [rng.getrandbits(64) for _ in range(3000)]
    text = lambda x: json.dumps(x, indent=2)
    make(root / "a.1.sig.zip", [("x.sig", text([{"class": "x", "signatures": [{"mins": many, "ksize": 31}, {"ksize": "21", "hashes": many[:7]}]}]))])
    make(root / "b.sig.zip", [("x.json", text({"ksize": 21, "mins": many[:50]})), ("y.sig.gz", gzip.compress(text([{"ksize": 31, "mins": [1, 2]}]).encode())), ("MANIFEST.csv", "no")])
    make(root / "c.sig.zip", [("x.sig", text({"name": "say \"mins\": [7, 8]", "signatures": [{"ksize": 31, "mins": []}, {"ksize": 31, "mins": [5, -1, 2**64 - 1]}]})), ("y.sig", "no json"), ("z.sig", text({"ksize": 51, "mins": [3]}))])
    make(root / "d.sig.zip", [("x.sig", text({"ksize": 31, "mins": [1, 2, "x", 4]})), ("y.sig", text({"ksize": 31, "mins": [9]}))])
    packed = gzip.compress(text([{"ksize": 31, "mins": many}]).encode())
    make(root / "e.sig.zip", [("x.sig.gz", packed[: len(packed) // 2]), ("y.sig", text({"ksize": 21, "mins": [3.0, "12"]}))])
    (root / "f.sig.zip").write_bytes(b"no archive")
    make(root / "g h%20+.sig.zip", [("x.sig", text({"ksize": 31, "mins": [77], "hashes": [78]}))])
    (root / "sub").mkdir()
    make(root / "sub" / "deep.sig.zip", [("x.sig", '{"mins" :  [ 1 ,\n 2 , 3 ], "ksize":31}')])


@pytest.fixture
def root(tmp_path):
    (tmp_path / "in").mkdir()
    hostile(tmp_path / "in")
    return tmp_path / "in"


def rows(df):
    return sorted((r.sample_id, r.ksize, r.hash, r.bucket) for r in df.collect())


def test_streamed_archives_equal_whole_ones(spark, root):
    want = rows(archives.read_archives(spark, str(root)))
    assert len(want) > 3000 and {r[0] for r in want} >= {"a", "b", "c", "d", "deep"}
    assert rows(archive_source.stream_archives(spark, str(root))) == want
    assert rows(archive_source.stream_archives(spark, str(root), groupBytes=1)) == want


@pytest.mark.parametrize("chunk", [7, 100, 1 << 20])
def test_entries_too_large_to_hold(root, monkeypatch, chunk):
    """Every entry is streamed, a few bytes at a time; faults excepted, whose place in a chunk decides what stood before."""
    monkeypatch.setattr(archive_source, "CHUNK", chunk)
    for path in sorted(root.rglob("*.sig.zip")):
        if path.name[0] in "def":
            continue
        for wanted in (frozenset(), frozenset([31])):
            whole = [(k, v) for k, run in archives.occurrences(path.read_bytes(), wanted, False) for v in run]
            streamed = [(k, int(v)) for k, run in archive_source.archive_runs(str(path), wanted, False, 0) for v in run]
            assert streamed == whole, path
    found = [(k, v.tolist()) for k, v in archive_source.archive_runs(str(root / "d.sig.zip"), frozenset(), False, 0)]
    assert found in ([(31, [1, 2])], [(31, [1]), (31, [2])]) or sum((v for _, v in found), []) == [1, 2]
    with pytest.raises((ValueError, TypeError)):
        list(archive_source.archive_runs(str(root / "d.sig.zip"), frozenset(), True, 0))


def test_text_of_a_large_entry_is_never_held(monkeypatch):
    """What a scan keeps of two million hashes is the record around them."""
    text = ('[{"name": "n", "signatures": [{"ksize": 31, "mins": [' + ",".join(str(i * 7919) for i in range(200_000)) + '], "md5": "x"}]}]').encode()
    around, largest, n = [], 0, 0
    monkeypatch.setattr(archive_source, "CHUNK", 4096)
    for _, piece in archive_source._scan(io.BytesIO(text), around):
        largest, n = max(largest, len(piece)), n + piece.count(b",") + 1
    assert n >= 200_000 and largest <= 3 * 4096 and len(b"".join(around)) < 200
    assert json.loads(b"".join(around))[0]["signatures"][0] == {"ksize": 31, "mins": [0], "md5": "x"}


def test_k_sizes_are_the_readers(spark, root):
    found = archive_source.stream_archives(spark, str(root)).where("ksize = 21")
    want = [r for r in rows(archives.read_archives(spark, str(root))) if r[1] == 21]
    assert rows(found) == want and want
    reader = archive_source.SigzipReader({"path": str(root)})
    from pyspark.sql.datasource import EqualTo, In, IsNotNull

    left = list(reader.pushFilters([IsNotNull(("ksize",)), EqualTo(("ksize",), 21), In(("ksize",), (21, 31)), EqualTo(("path",), "x")]))
    assert reader.ksizes == {21} and [type(f).__name__ for f in left] == ["IsNotNull", "EqualTo"]
    assert rows(archive_source.stream_archives(spark, str(root)).where("ksize IN (21, 51)")) == [r for r in rows(archives.read_archives(spark, str(root))) if r[1] in (21, 51)]


def test_failfast_raises(spark, root):
    with pytest.raises(PySparkException):
        archive_source.stream_archives(spark, str(root), mode="failfast").count()


def occurrences(spark, n, parts=4):
    return spark.range(n).select(F.lit("d").alias("dir"), F.concat(F.lit("s"), F.col("id") % 40).alias("name"), F.lit(31).alias("ksize"), F.col("id").alias("hash")).repartition(parts, "name").sortWithinPartitions("dir", "name", "ksize", "hash")


def left_in(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("*") if p.is_file())


def test_commit_moves_and_abort_clears(spark, tmp_path):
    archive_source.register(spark)
    out = tmp_path / "out"
    occurrences(spark, 4000).write.format("sigzip").mode("append").save(str(out))
    assert left_in(out) == sorted(f"d/s{i}.sig.zip" for i in range(40))
    assert archive_source.stream_archives(spark, str(out)).count() == 4000

    def killed(batches):
        for i, batch in enumerate(batches):
            yield batch
            if i == 1:
                os._exit(9)  # the worker dies in the middle, with archives of this task and of others written

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        fails = occurrences(spark, 8000)
        dying = fails.mapInArrow(killed, fails.schema)
        with pytest.raises((PySparkException, Py4JError)):
            dying.write.format("sigzip").mode("append").save(str(tmp_path / "dying"))
        # a task that raises leaves the archives that were there before as they were
        nulls = occurrences(spark, 8000).withColumn("hash", F.when(F.col("hash") != 7777, F.col("hash")))
        with pytest.raises((PySparkException, Py4JError)):
            nulls.write.format("sigzip").mode("append").save(str(out))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for _ in range(50):  # tasks that outlive the abort end on their own
        if len(left_in(tmp_path)) == 40:
            break
        time.sleep(0.2)
    assert left_in(tmp_path) == sorted(f"out/d/s{i}.sig.zip" for i in range(40))
    assert archive_source.stream_archives(spark, str(out)).count() == 4000
    with pytest.raises(PySparkException):
        occurrences(spark, 10).write.format("sigzip").mode("overwrite").save(str(out))
