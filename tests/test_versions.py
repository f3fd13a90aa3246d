"""Versions under a pointer, the hash index, loads that fail in the middle."""

import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hashloom import schema
from hashloom.operators.dedup import unique_hashes
from hashloom.sources import hash_index, tables, versions

HASHES = "ksize smallint, hash long, bucket int"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_versions_and_loads(spark, tmp_path):
    t = versions.VersionedTable(spark, f"{tmp_path}/t")
    assert t.version() == -1 and t.snapshot()["parts"] == {}
    with pytest.raises(ValueError, match="no version"):
        t.read()
    assert t.append(spark.range(3), "a") == 0
    assert t.append(spark.range(3), "a") == 0  # a repeated load counts once
    assert t.append(spark.range(3, 5), "b") == 1
    old = t.snapshot()
    assert {(r.id, r.seq) for r in t.read(seq=True).collect()} == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 1)}
    assert t.replace(spark.range(9)) == 2 and ids(t.read()) == list(range(9))
    assert ids(t.read(old)) == [0, 1, 2, 3, 4]  # the version before is there as long as nobody vacuums
    assert t.vacuum(keep=1, grace=0) == 2 and t.vacuum(keep=1, grace=0) == 0
    assert ids(t.read()) == list(range(9)) and t.version() == 2
    t.stage(spark.range(1))
    assert t.vacuum(keep=1) == 0  # a young part may be about to be committed
    assert t.replace(spark.range(0)) == 3 and t.read().count() == 0


def test_newest_and_compact(spark, tmp_path):
    t = versions.VersionedTable(spark, f"{tmp_path}/t")
    for values in ([(1, "a"), (2, "a")], [(2, "b")], [(1, None), (3, "c")]):
        t.append(spark.createDataFrame(values, "id long, v string"))
    want = {(1, None), (2, "b"), (3, "c")}
    assert {tuple(r) for r in versions.newest(t.read(seq=True), "id").collect()} == want
    assert t.compact(lambda rows: versions.newest(rows, "id")) == 3
    assert len(t.snapshot()["parts"]) == 1 and {tuple(r) for r in t.read().collect()} == want
    assert t.compact(lambda rows: rows) == 3  # one part has nothing to merge


def test_writers_at_once(spark, tmp_path):
    t = versions.VersionedTable(spark, f"{tmp_path}/t")
    base = t.snapshot()
    part = t.stage(spark.range(1))
    assert t.commit(base, {part: 0}, spark.range(1).schema) == 0
    with pytest.raises(versions.Conflict):
        t.commit(base, {part: 0}, spark.range(1).schema)
    with ThreadPoolExecutor(4) as pool:
        found = list(pool.map(lambda k: t.append(spark.range(10 * k, 10 * k + 10), f"load{k}"), range(1, 9)))
    assert sorted(found) == list(range(1, 9))
    assert ids(t.read()) == [0, *range(10, 90)]


def test_compact_keeps_what_others_append(spark, tmp_path):
    t = versions.VersionedTable(spark, f"{tmp_path}/t")
    for k in range(3):
        t.append(spark.range(k, k + 1))

    def merge(rows):
        merged = rows.select("id")
        t.append(spark.range(7, 8))  # meanwhile
        return merged

    t.compact(merge)
    assert ids(t.read()) == [0, 1, 2, 7] and len(t.snapshot()["parts"]) == 2


@pytest.fixture
def indexed(spark, tmp_path):
    rng = random.Random(4)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(20_000)]
    rows = [(k, h, h % 521) for h in values for k in ((21, 31) if h % 3 == 0 else (31,))]
    spark.createDataFrame(rows, HASHES).repartitionByRange(16, "hash").sortWithinPartitions("hash").write.parquet(f"{tmp_path}/files")
    hash_index.build_index(spark.read.parquet(f"{tmp_path}/files"), f"{tmp_path}/index")
    return values, f"{tmp_path}/index"


def asked(spark, values):
    return spark.createDataFrame([(v,) for v in values], "hash long")


def test_probe_opens_only_the_files_that_can_answer(spark, indexed):
    values, index = indexed
    known = hash_index.manifest(spark, index)
    assert known.count() == 16 and known.agg(F.sum("n_rows")).first()[0] == len(values) + sum(h % 3 == 0 for h in values)
    few = [values[5], values[77], 1, 2, 3, None, values[5]]
    rows, files = hash_index.opened(asked(spark, few), index)
    assert sorted((r.ksize, r.hash) for r in rows.collect()) == sorted((k, h) for h in {values[5], values[77]} for k in ((21, 31) if h % 3 == 0 else (31,)))
    read = [f for f in rows.inputFiles() if "/files/" in f]
    assert len(files) <= 3 and {f.rsplit("/", 1)[1] for f in read} == {f.rsplit("/", 1)[1] for f in files}
    rows, files = hash_index.opened(asked(spark, []), index)
    assert rows.collect() == [] and files == []
    everything = asked(spark, values)
    rows, files = hash_index.opened(everything, index)
    assert rows.select("hash").distinct().count() == len(set(values)) and len(files) == 16


def test_bitmaps_lose_nothing_and_turn_most_others_away(spark, indexed):
    values, index = indexed
    rng = random.Random(8)
    others = [rng.getrandbits(64) - (1 << 63) for _ in range(5_000)]
    found = {(r.h) for r in hash_index.candidates(asked(spark, values + others), index).collect()}
    assert set(values) <= found
    assert len(found - set(values)) < 0.05 * len(others)


def test_index_of_unsorted_files(spark, tmp_path):
    rows = [(31, h * 7919 - 50_000, 0) for h in range(3_000)]
    spark.createDataFrame(rows, HASHES).repartition(5).write.parquet(f"{tmp_path}/files")
    hash_index.build_index(spark.read.parquet(f"{tmp_path}/files"), f"{tmp_path}/index")
    found = hash_index.probe(asked(spark, [r[1] for r in rows[::10]] + [11]), f"{tmp_path}/index")
    assert sorted(r.hash for r in found.collect()) == sorted(r[1] for r in rows[::10])


def test_probe_of_a_loaded_table(spark, tmp_path):
    unique = unique_hashes(spark.createDataFrame([("a", 31, h, h % 521) for h in range(500)], schema.OCCURRENCES))
    index = f"{tmp_path}/index"
    tables.ingest(unique, "probed", "create", index=index)
    assert sorted(r.hash for r in tables.probe(asked(spark, [3, 499, 500]), "probed", index).collect()) == [3, 499]
    tables.ingest(unique.withColumn("hash", F.col("hash") + 500), "probed", "append", index=index)
    assert sorted(r.hash for r in tables.probe(asked(spark, [3, 500, 1500]), "probed", index).collect()) == [3, 500]
    tables.ingest(unique.where("hash > 3"), "probed", "replace", index=index)
    assert sorted(r.hash for r in tables.probe(asked(spark, [3, 4, 500]), "probed", index).collect()) == [4]
    tables.drop(spark, "probed")
    with pytest.raises(ValueError, match="no table"):
        tables.probe(asked(spark, [1]), "probed", index)


@pytest.mark.parametrize("step", ["_write_version", "_finish", "_point", "_drop_version"])
def test_a_failed_replace_leaves_old_or_new(spark, monkeypatch, step):
    """Every step of a load fails in turn, before and after it is done: the name never goes, and holds the old rows or the new ones."""
    table = f"swapped{step}"
    old, new = (spark.createDataFrame([(31, h, h) for h in hashes], HASHES) for hashes in ([1, 2], [3, 4, 5]))
    tables.ingest(old, table, "create")
    done = getattr(tables, step)
    for late in (False, True):

        def fails(*args, late=late):
            if late:
                done(*args)
            raise RuntimeError("injected")

        with monkeypatch.context() as m:
            m.setattr(tables, step, fails)
            with pytest.raises(RuntimeError, match="injected"):
                tables.ingest(new, table, "replace")
        assert sorted(r.hash for r in spark.table(table).collect()) in ([1, 2], [3, 4, 5])
    tables.sweep(spark, table)
    assert [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{table}__v*'").collect()] == [tables.current(spark, table).split(".")[-1]]
    assert tables.ingest(new, table, "replace") == 3
    tables.drop(spark, table)
    assert not spark.catalog.tableExists(table)


def test_a_schema_may_change_with_a_replace(spark):
    tables.ingest(spark.createDataFrame([(31, 1, 1)], HASHES), "changing", "create")
    tables.ingest(spark.createDataFrame([(1, 1, 9)], "hash long, bucket int, n_samples long"), "changing", "replace")
    assert spark.table("changing").columns == ["hash", "bucket", "n_samples"]
    spark.sql("CREATE TABLE plain_one AS SELECT 1 AS hash")
    with pytest.raises(ValueError, match="no table of this loader"):
        tables.ingest(spark.table("changing"), "plain_one", "replace")
    tables.drop(spark, "changing")
    spark.sql("DROP TABLE plain_one")
