"""Sorted bucket files merged, bucketed tables folded, long records cut over tasks."""

import random

import pytest
from pyspark.errors import PySparkException

from hashloom.operators import compare, dedup, sketch_files
from hashloom.sources import archives, merged, tables

KINDS = "ksize smallint, hash long, bucket int"


def collections(spark, seed, n):
    rng = random.Random(seed)
    values = [(rng.choice([21, 31]), rng.randrange(-400, 400)) for _ in range(n)] + [(31, -(2**63)), (21, 2**63 - 1)]
    return spark.createDataFrame([(k, h, h % 7) for k, h in values], KINDS)


@pytest.mark.parametrize("batch_rows", [1, 5, 65_536])
def test_merged_files_are_the_distinct_hashes(spark, tmp_path, batch_rows):
    sets = [collections(spark, seed, 500) for seed in (1, 2, 3)]
    for i, rows in enumerate(sets):
        tables.write_unique(dedup.unique_hashes(rows), f"{tmp_path}/{i}", files_per_bucket=3)
    every = sets[0].union(sets[1]).union(sets[2])
    got = merged.read_merged(spark, *(f"{tmp_path}/{i}" for i in range(3)), batch_rows=batch_rows)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == {tuple(r) for r in every.distinct().collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    flat = [dedup.unique_hashes(rows, False) for rows in sets[:2]]
    for i, rows in enumerate(flat):
        tables.write_unique(rows, f"{tmp_path}/flat{i}")
    got = merged.read_merged(spark, f"{tmp_path}/flat0", f"{tmp_path}/flat1", by_ksize=False, batch_rows=batch_rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, flat[0].union(flat[1]).distinct().collect()))


def test_files_that_are_not_sorted_raise(spark, tmp_path):
    spark.createDataFrame([(31, h, 0) for h in (5, 3, 9)], KINDS).coalesce(1).write.partitionBy("bucket").parquet(f"{tmp_path}/bad")
    with pytest.raises(PySparkException):
        merged.read_merged(spark, f"{tmp_path}/bad").collect()
    with pytest.raises(PySparkException):
        merged.read_merged(spark, f"{tmp_path}/bad", batch_rows=1).collect()


def test_512_buckets_meet_64_without_an_exchange(spark):
    rows = collections(spark, 5, 300).select("ksize", "hash").distinct()
    other = collections(spark, 6, 300).select("ksize", "hash").distinct()
    want = {tuple(r) for r in rows.join(other, ["ksize", "hash"], "left_semi").collect()}
    for name, df, buckets in (("fine", rows, 512), ("coarse", other, 64), ("odd", other, 521)):
        tables.drop(spark, name)
        tables.ingest(df, name, "create", buckets=buckets)
    with compare.folded_buckets(spark):
        folded = compare.known(spark.table("fine"), spark.table("coarse"))
        plan = folded._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and {tuple(r) for r in folded.collect()} == want
        # 521 and 512 have no common buckets: one side moves, the other stays
        rehashed = compare.known(compare.rebucketed(spark.table("fine"), 521), spark.table("odd"))
        plan = rehashed._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and {tuple(r) for r in rehashed.collect()} == want
    assert spark.conf.get("spark.sql.bucketing.coalesceBucketsInJoin.enabled") == "false"
    for name in ("fine", "coarse", "odd"):
        tables.drop(spark, name)


def fasta(path, seed):
    """Records with lines of many lengths, blank lines, blanks and carriage returns, headers with > inside, a record on one line, a file that ends in a header."""
    rng = random.Random(seed)
    out = [b"ACGTACGTAACC\n"] if seed % 2 else []
    for r in range(6):
        out.append(b">rec > %d %s\n" % (r, b"x" * rng.randrange(60)))
        bases = bytes(rng.choice(b"ACGTacgtN" if r % 2 else b"ACGU") for _ in range(rng.choice([0, 3, 500, 900])))
        i = 0
        while i < len(bases):
            n = len(bases) if r == 3 else rng.randrange(1, 80)
            out.append(bases[i : i + n] + rng.choice([b"\n", b"\n", b"\r\n", b" \n", b"\n\n"]))
            i += n
    if seed % 3 == 0:
        out.append(b">last")
    path.write_bytes(b"".join(out))


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 20])
def test_pieces_of_a_file_have_every_k_mer_once(tmp_path, size):
    for seed in range(6 if size > 1 else 2):
        path = tmp_path / f"{seed}.fa"
        fasta(path, seed)
        store, at = archives.opened(str(path))
        k = 9
        with store.open_input_stream(at) as f:
            want = sorted(s[i : i + k] for s in sketch_files.records(sketch_files.iter_lines(f)) for i in range(len(s) - k + 1))
        got = []
        for start in range(0, path.stat().st_size, size):
            for bases, n in sketch_files.pieces(store, at, start, start + size, k - 1):
                got += [bases[i : i + k] for i in range(n) if len(bases[i : i + k]) == k]
        assert sorted(got) == want, (seed, size)


def test_cut_files_give_the_archives_of_whole_ones(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for seed in range(4):
        fasta(tmp_path / "in" / f"{seed}.fa", seed)
    files = archives.scan_fasta(spark, f"{tmp_path}/in")
    whole, cut = f"{tmp_path}/whole", f"{tmp_path}/cut"
    sketch_files.sketch_to_archives(files, whole, (9, 15), 2, rna=True, n_shards=16).collect()
    done = sketch_files.sketch_large_to_archives(files, cut, (9, 15), 2, rna=True, n_shards=16, size=100).collect()
    assert len(done) == 4
    kinds = lambda root: {tuple(r) for r in archives.read_archives(spark, root, mode="failfast").collect()}
    assert kinds(whole) == kinds(cut) and len(kinds(cut)) > 500
    places = lambda root: sorted(str(p.relative_to(root)) for p in (tmp_path / root).rglob("*.zip"))
    assert places(whole) == places(cut)
