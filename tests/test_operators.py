"""Sketches, comparisons, the queue, traversal and streams on small relations."""

import random

import pytest
from pyspark.sql import functions as F

from hashloom import schema
from hashloom.operators import compare, dedup, sketch, traversal, workqueue
from hashloom.streaming import incremental

NOW = 10_000.0


def test_sketch_is_strand_neutral(spark):
    seq = "ACGTTGCAAGCTTACGGATCCATGACCGTTAGC" * 3
    back = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    df = spark.createDataFrame([("f", seq), ("r", back), ("short", "ACG"), ("n", None)], "s string, t string")
    for name in sketch.HASHES:
        got = sketch.sketch(df, "t", "s", (21,), 1, name, dna=True).select("sample_id", "hash").distinct().collect()
        by = {s: {r.hash for r in got if r.sample_id == s} for s in ("f", "r", "short")}
        assert by["f"] == by["r"] and len(by["f"]) > 20 and not by["short"]


def test_sketch_skips_other_letters_and_scales(spark):
    df = spark.createDataFrame([("a", "ACGTNACGTA")], "s string, t string")
    assert sketch.sketch(df, "t", "s", (5,), 1, "murmur3_64", dna=True).count() == sketch.sketch(df, "t", "s", (5,), 1, "md5_60", dna=True).select("hash").distinct().count() == 1
    long = spark.createDataFrame([("a", "".join(chr(97 + i * i % 23) for i in range(3000)))], "s string, t string")
    all_, some = (sketch.sketch(long, "t", "s", (9,), n, "md5_60").count() for n in (1, 4))
    assert some < all_ == 2992


def test_pieces_cover_every_position(spark):
    import hashlib

    text = "".join(chr(0x61 + (i * 7 + i // 13) % 26) if i % 5 else "é" for i in range(2000))
    k = 31
    want = {int(hashlib.md5(min(g, g[::-1]).encode()).hexdigest()[:15], 16) for g in (text[i : i + k] for i in range(len(text) - k + 1))}
    got = {r.hash for r in sketch.sketch(spark.createDataFrame([("a", text)], "s string, t string"), "t", "s", (k,), 1).collect()}
    assert got == want


def test_sketch_makes_no_row_per_position(spark):
    """Texts of a batch are one run of bytes: no shingle crosses from one into the next, and none is a row before it is known to be kept."""
    import hashlib

    texts = [("a", "xyz" * 9000), ("a", ""), ("b", None), ("b", "é"), ("c", "zäy" * 12_000), ("d", "xyzä"), ("e", "zyxwvut")]
    df = spark.createDataFrame(texts, "s string, t string").coalesce(1)
    found = sketch.sketch(df, "t", "s", (5, 33), 1)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.sample_id, r.ksize, r.hash, r["count"]) for r in found.groupBy("sample_id", "ksize", "hash").count().collect())
    want: dict = {}
    for s, t in texts:
        for k in (5, 33):
            for i in range(len(t or "") - k + 1):
                g = t[i : i + k]
                key = (s, k, int(hashlib.md5(min(g.encode(), g[::-1].encode())).hexdigest()[:15], 16))
                want[key] = want.get(key, 0) + 1
    assert got == sorted((*key, n) for key, n in want.items())


def test_sketch_of_bases_skips_a_last_line_end(spark):
    df = spark.createDataFrame([("a", "ACGTA\n")], "s string, t string")
    assert sketch.sketch(df, "t", "s", (6,), 1, "md5_60", dna=True).count() == sketch.sketch(df, "t", "s", (6,), 1, "murmur3_64", dna=True).count() == 0


def test_compare(spark):
    left = compare.normalised(spark.createDataFrame([(1,), (2,), (2,), (3,)], "hash long"), ksize_col=None, ksize=31)
    right = compare.normalised(spark.createDataFrame([(31, 2), (21, 3)], "ksize int, hash long"))
    assert [r.hash for r in compare.known(left, right).collect()] == [2]
    assert sorted(r.hash for r in compare.novel(left, right).collect()) == [1, 3]
    assert [tuple(r) for r in compare.containment(left, right).collect()] == [(31, 3, 1, 1 / 3)]
    with pytest.raises(ValueError, match="ksize"):
        compare.normalised(left, ksize_col=None)


def test_catalog_comparison(spark, tmp_path):
    """Seventy collections, two words of bits; one without a k column; a left one that shares nothing."""
    import json

    sets = {f"s{i}": [(31, i), (31, 1000), (21, i % 2)] for i in range(68)} | {"alone": [(31, -5)], "plain": [(None, 1000), (None, 3), (None, 3)]}
    entries = []
    for name, rows in sets.items():
        df = spark.createDataFrame(rows, "k int, h long")
        (df.select("h") if name == "plain" else df).coalesce(1).write.parquet(f"{tmp_path}/{name}/hashes")
        entries.append({"name": name, "alias": name, "path": f"{tmp_path}/{name}", "table": "hashes", "column": "h", "set_id": "left" if name in ("s0", "alone", "plain") else "right", "ksize": None if name == "plain" else "k"})
    (tmp_path / "catalog.json").write_text(json.dumps({"databases": entries}, indent=2))
    with pytest.raises(ValueError, match="ksize"):
        compare.compare_catalog(spark, f"{tmp_path}/catalog.json")
    overlaps, coverage = compare.compare_catalog(spark, f"{tmp_path}/catalog.json", ksize=31)
    of = lambda rows, k: {h for kk, h in rows if (kk or 31) == k}
    want = set()
    for left in ("s0", "alone", "plain"):
        for right in (f"s{i}" for i in range(1, 68)):
            for k in (21, 31):
                a, b = of(sets[left], k), of(sets[right], k)
                if a or b:
                    want.add((k, left, right, len(a), len(b), len(a & b), len(a & b) / len(a) if a else None))
    assert {tuple(r) for r in overlaps.collect()} == want
    assert {tuple(r) for r in coverage.collect()} == {(31, "s0", 2, 1, 1), (21, "s0", 1, 1, 0), (31, "alone", 1, 0, 1), (31, "plain", 2, 2, 0)}
    plan = compare.masks(compare.catalog_sets(spark, f"{tmp_path}/catalog.json", 31)[1])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_counts_are_kept_up_by_loads(spark, tmp_path):
    import shutil

    from hashloom.operators.counting import SampleCounts

    rng = random.Random(6)
    loads = [[(rng.choice([None, *(f"s{i}" for i in range(90))]), rng.choice([21, 31]), h := rng.randrange(60), h % 521) for _ in range(400)] for _ in range(4)]
    counts = SampleCounts(spark, f"{tmp_path}/counts")
    for k, rows in enumerate(loads):
        path = f"{tmp_path}/load{k}"
        spark.createDataFrame(rows, schema.OCCURRENCES).write.parquet(path)
        counts.load(spark.read.parquet(path), f"load{k}")
        counts.load(spark.read.parquet(path), f"load{k}")  # a repeated load changes nothing
        shutil.rmtree(path)  # rows of earlier loads aren't read again
        if k == 2:
            counts.compact(2)
    every = spark.createDataFrame([r for rows in loads for r in rows], schema.OCCURRENCES)
    for by_ksize in (True, False):
        want = {tuple(r) for r in dedup.unique_hashes(every, by_ksize, True).collect()}
        assert {tuple(r) for r in counts.counts(by_ksize).collect()} == want
    assert len(counts.words.snapshot()["parts"]) == 2 and counts.samples.read().count() == len({r[0] for rows in loads for r in rows if r[0]})
    assert counts.counts()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_counts_of_loaders_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from hashloom.operators.counting import SampleCounts

    rows = {k: [(f"s{k}", 31, h, h) for h in range(5)] for k in range(4)}
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: SampleCounts(spark, str(tmp_path)).load(spark.createDataFrame(rows[k], schema.OCCURRENCES), str(k)), rows))
    counts = SampleCounts(spark, str(tmp_path))
    assert {r.n_samples for r in counts.counts().collect()} == {4}
    assert sorted(r.number for r in counts.samples.read().collect()) == [0, 1, 2, 3]


def test_count_stream(spark, tmp_path):
    source, root, mark = (str(tmp_path / x) for x in ("in", "counts", "mark"))
    from hashloom.operators.counting import SampleCounts

    for sample in "ab":
        spark.createDataFrame([(sample, 31, h, h) for h in (1, 2)], schema.OCCURRENCES).write.mode("append").parquet(source)
        incremental.count_stream(incremental.occurrence_stream(spark, source, schema.OCCURRENCES), root, mark)
    assert {(r.hash, r.n_samples) for r in SampleCounts(spark, root).counts().collect()} == {(1, 2), (2, 2)}


@pytest.fixture
def state(spark):
    rows = [
        (1, "PENDING", 0, 1.0), (2, "ERROR", 3, NOW - 4000), (3, "ERROR", 3, NOW - 10), (4, "ERROR", 20, NOW - 9000), (5, "ERROR", 1, None),
        (6, "DOWNLOADING", 0, NOW - 4000), (7, "SKETCHING", 0, NOW - 10), (8, "DONE", 1, 1.0), (9, "PENDING", 0, None),
    ]
    full = [(i, "d", f"f{i}", f"u{i}", None, None, s, t, None, None, u, 0.0) for i, s, t, u in rows]
    return spark.createDataFrame(full, schema.QUEUE)


def by_id(df, *cols):
    return {r.id: tuple(r[c] for c in cols) for r in df.collect()}


def test_claim(state):
    chosen, after = workqueue.claim(state, 4, NOW)
    assert [r.id for r in chosen.collect()] == [1, 9, 5, 2]
    assert {i for i, (s, u) in by_id(after, "status", "updated_at").items() if s == "DOWNLOADING" and u == NOW} == {1, 9, 5, 2}
    assert after.count() == state.count()


def test_reset_mark_verify(spark, state):
    assert {i for i, (s,) in by_id(workqueue.reset_stuck(state, NOW), "status").items() if s == "PENDING"} == {1, 6, 9}
    change = spark.createDataFrame([(7, "ERROR", None, "bad", True)], "id long, status string, out_path string, last_error string, inc_tries boolean")
    assert by_id(workqueue.mark(state, change, NOW), "status", "tries", "last_error")[7] == ("ERROR", 1, "bad")
    probes = spark.createDataFrame([("u1", 200), ("u2", 404)], "url string, code int")
    assert by_id(workqueue.verify(state, probes, NOW), "status")[9] == ("ERROR",)
    assert by_id(workqueue.verify(state, probes, NOW), "status")[1] == ("PENDING",)


def test_upsert_keeps_status(spark, state):
    files = spark.createDataFrame([("d", "f8", "new", 5, "m"), ("d", "z", "u", None, None), ("c", "z", "u", None, None)], "subdir string, filename string, url string, size long, mtime string")
    got = by_id(workqueue.upsert(state, files, NOW), "subdir", "filename", "url", "status", "tries")
    assert got[8] == ("d", "f8", "new", "DONE", 1)
    assert got[10] == ("c", "z", "u", "PENDING", 0) and got[11] == ("d", "z", "u", "PENDING", 0)
    again = workqueue.upsert(workqueue.upsert(state, files, NOW), files, NOW)
    assert again.count() == 11


def test_stats_and_end(state):
    assert {r.status: r.n for r in workqueue.stats(state).collect()} == {"PENDING": 2, "ERROR": 4, "DOWNLOADING": 1, "SKETCHING": 1, "DONE": 1, "total": 9}
    assert not workqueue.is_drained(state, NOW)
    assert workqueue.is_drained(state.where("status = 'DONE' OR tries >= 20"), NOW)
    assert [r.id for r in workqueue.next_batch(state, 2, after=1).collect()] == [2, 3]


def test_reachable_stops_at_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("x", "y")], "parent string, child string")
    roots = spark.createDataFrame([("a",)], "n string")
    assert {tuple(r) for r in traversal.reachable(edges, roots).collect()} == {("a", 0), ("b", 1), ("c", 1)}
    assert {tuple(r) for r in traversal.reachable(edges, roots, max_depth=0).collect()} == {("a", 0)}


def test_crawl(spark):
    from hashloom.sources.listings import listing_links

    html = {"": '<a href="../">u</a><a HREF="sub/">s</a><a href="a.fna.gz">a</a><a href="a.txt">t</a>', "sub/": '<a href="b.fna.gz?C=1">b</a><a href="/abs/">x</a>', "lost/": '<a href="c.fna.gz">c</a>'}
    pages = listing_links(spark.createDataFrame(list(html.items()), "url string, html string"))
    got = traversal.crawl(pages, "https://h/base/", r".*\.fna\.gz$").collect()
    assert sorted((r.subdir, r.filename, r.url) for r in got) == [("", "a.fna.gz", "https://h/base/a.fna.gz"), ("sub", "b.fna.gz", "https://h/base/sub/b.fna.gz")]
    assert traversal.crawl(pages, "https://h/base/", r".*\.fna\.gz$", max_depth=0).count() == 1


def test_examples(spark):
    paths = ["/genomes/a.fna", "/p/x/deep.fna", "/p/top.txt", "/p/z.fa", "/q/../a.fna", "/r/a b.fsa_nt.gz"]
    got = traversal.subtree_examples(spark.createDataFrame([(p,) for p in paths], "path string"), "h").select("subtree", "url").collect()
    assert sorted(tuple(r) for r in got) == [("/p/", "https://h/p/z.fa"), ("/r/", "https://h/r/a%20b.fsa_nt.gz")]


def test_even_chunks(spark):
    got = dedup.even_chunks(spark.range(10), "id", 4).groupBy("worker").agg(F.count("id").alias("n"), F.min("id").alias("lo")).orderBy("worker").collect()
    assert [tuple(r) for r in got] == [(0, 3, 0), (1, 3, 3), (2, 2, 6), (3, 2, 8)]
    assert dedup.even_chunks(spark.range(2), "id", 4).count() == 2


def test_stream_takes_up_what_is_new(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    one = spark.createDataFrame([("a", 31, h, h) for h in (1, 2, 2)], schema.OCCURRENCES)
    one.write.parquet(source)
    stream = lambda: incremental.dedup_stream(incremental.occurrence_stream(spark, source, schema.OCCURRENCES))
    incremental.run_available(stream(), out, mark)
    assert spark.read.parquet(out).count() == 2
    spark.createDataFrame([("b", 31, h, h) for h in (2, 3)], schema.OCCURRENCES).write.mode("append").parquet(source)
    incremental.run_available(stream(), out, mark)
    assert sorted(r.hash for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    assert {(r.hash, r.n_samples) for r in incremental.recount(spark, source, schema.OCCURRENCES).collect()} == {(1, 1), (2, 2), (3, 1)}


def test_queue_stream(spark, state, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "state")
    state.write.parquet(source)
    events = spark.readStream.schema(schema.QUEUE).parquet(source)
    incremental.queue_stream(events, path, str(tmp_path / "mark"))
    state.where("id = 1").withColumn("status", F.lit("DONE")).withColumn("updated_at", F.lit(NOW)).write.mode("append").parquet(source)
    incremental.queue_stream(spark.readStream.schema(schema.QUEUE).parquet(source), path, str(tmp_path / "mark"))
    last = spark.read.parquet(f"{path}/v1")
    assert last.count() == 9 and by_id(last, "status")[1] == ("DONE",)


def test_worker_round(spark, state):
    def work(todo):
        fine = todo.where("id <> 9").select("id", F.concat(F.lit("/o/"), "filename").alias("out_path"), F.when(F.col("id") == 5, "broken").alias("error"))
        return fine

    done = spark.createDataFrame([("d", "f2", "/old")], "subdir string, filename string, out_path string")
    after, counts = workqueue.run_batch(state, 4, NOW, work, done)
    got = by_id(after, "status", "tries", "out_path", "last_error")
    assert got[1] == ("DONE", 0, "/o/f1", None) and got[2] == ("DONE", 3, "/old", None)
    assert got[5] == ("ERROR", 2, None, "broken") and got[9] == ("ERROR", 1, None, "no result")
    assert got[3][0] == "ERROR" and got[6][0] == "DOWNLOADING"
    assert {(r.outcome, r.n, *sorted(r.examples)) for r in counts.collect()} == {("done", 1), ("skipped", 1), ("error", 2, "broken", "no result")}
    after, counts = workqueue.run_batch(state, 4, NOW, work, done, attempts=3)
    got = by_id(after, "status", "tries")
    assert got[1] == ("DONE", 0) and got[5] == ("ERROR", 4) and got[9] == ("ERROR", 3)
    assert [r.id for r in workqueue.pending(state, 5, after=1).collect()] == [9]


def test_worker_loop(spark, state, tmp_path):
    """Rounds go on until nothing can be claimed; a row that fails at first succeeds at its second attempt."""
    seen = []

    def work(todo):
        ids = [r.id for r in todo.orderBy("id").collect()]
        seen.append(ids)
        again = [i for i in ids if i == 5 and sum(5 in x for x in seen) < 2]
        return todo.select("id", F.lit("/o").alias("out_path"), F.when(F.col("id").isin(again), "later").alias("error"))

    last, totals = workqueue.run_queue(state, str(tmp_path / "v"), 2, work, clock=lambda: NOW, attempts=2)
    got = by_id(last, "status", "tries")
    assert got[5] == ("DONE", 2) and got[1][0] == got[9][0] == "DONE" and totals["error"] == 0 and totals["done"] >= 3
    assert last.where(workqueue.claim_order(NOW)[0]).isEmpty() and workqueue.QueueStore(spark, str(tmp_path / "v")).state().count() == 9


def test_subtree_caps(spark):
    paths = [f"/a/d{k}/x{k}.txt" for k in range(3)] + ["/a/d9/y.fna", "/b/z.fna"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    found = lambda **caps: {r.subtree for r in traversal.subtree_examples(files, "h", **caps).collect()}
    assert found() == found(max_dirs=4, max_files=4) == {"/a/", "/b/"}
    assert found(max_dirs=3) == found(max_files=3) == {"/b/"}


def test_progress_listener(spark, tmp_path):
    import time

    source = str(tmp_path / "in")
    spark.createDataFrame([("a", 31, h, h) for h in (1, 2, 2)], schema.OCCURRENCES).write.parquet(source)
    seen = incremental.Progress()
    spark.streams.addListener(seen)
    stream = incremental.dedup_stream(incremental.occurrence_stream(spark, source, schema.OCCURRENCES))
    query = incremental.run_available(stream, str(tmp_path / "out"), str(tmp_path / "mark"))
    for _ in range(50):
        if not seen.latest.get(str(query.id), {"running": True})["running"]:
            break
        time.sleep(0.1)
    spark.streams.removeListener(seen)
    assert seen.latest[str(query.id)]["rows"] == 3 and not seen.latest[str(query.id)]["running"]


def test_tasks_follow_the_bytes(spark, monkeypatch):
    """Beyond the session's number of tasks an aggregate's share of keys stays the same; the counts do too."""
    from hashloom import tasks

    rows = spark.range(3000).selectExpr("cast(id % 7 as string) AS sample_id", "cast(21 as smallint) AS ksize", "id % 500 AS hash", "cast(id % 5 as int) AS bucket")
    want = {tuple(r) for r in dedup.unique_hashes(rows, True, True).collect()}
    monkeypatch.setattr(tasks, "TASK_BYTES", 1000)
    found = dedup.unique_hashes(rows, True, True)
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in found.collect()} == want and len(want) == 500
