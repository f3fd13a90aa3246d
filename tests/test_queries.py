"""Every registered query of the engine against its SQL on the smallest tables."""

import pytest

from hashloom.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows(columns, values):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in values)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    got = rows(df.columns, [r.asDict() for r in df.collect()])
    assert got or name == "target_pages"
    if name in ORACLES:
        want = oracle.sql(ORACLES[name])
        columns = want.columns
        assert sorted(columns) == sorted(df.columns)
        assert got == rows(columns, [dict(zip(columns, r, strict=True)) for r in want.fetchall()])


def test_entry_without_corpus_operators(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert entry.entry(spark).count() > 0


def test_plans_prune_and_combine(spark):
    plan = QUERIES["dedup_ksize_hash"](spark, SF)._jdf.queryExecution().toString()
    scan = plan[plan.rindex("FileScan parquet") :].split("ReadSchema", 1)[1].split("\n", 1)[0]
    assert "l_partkey" in scan and "l_comment" not in scan and "l_suppkey" not in scan
    assert plan.count("Exchange hashpartitioning") <= 2
    pushed = QUERIES["filter_ksizes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_linenumber" in pushed.split("PushedFilters", 1)[1]


def test_claim_takes_the_next_of_the_whole_queue(spark, tmp_path):
    from hashloom.operators import workqueue
    from hashloom.plans import queries

    pending = queries.queue(spark, SF).where("status = 'PENDING'").orderBy("id").limit(400).collect()
    claimed = [r.id for r in QUERIES["queue_claim"](spark, SF).collect()]
    assert claimed[: len(pending)] == [r.id for r in pending]
    # more PENDING rows than are claimed at once: only they are claimed, and a later claim goes on to the ERROR rows
    kinds = [(i, "error" if i % 10 == 0 else "signup") for i in range(1, 701)]
    spark.createDataFrame(kinds, "event_id long, event_type string").selectExpr("event_id", "event_id AS user_id", "event_type").write.parquet(f"{tmp_path}/events.parquet")
    waiting = [i for i, kind in kinds if kind == "signup"]
    assert [r.id for r in QUERIES["queue_claim"](spark, str(tmp_path)).collect()] == waiting[:400]
    _, state = workqueue.claim(queries.queue(spark, str(tmp_path)), 400, queries.NOW)
    second = [r.id for r in workqueue.claim(state, 400, queries.NOW)[0].collect()]
    assert second[:230] == waiting[400:] and len(second) > 230 and all(i % 10 == 0 for i in second[230:])


def test_all_buckets_are_listed(spark, tmp_path):
    hashes = [0, 1, 2, 5, 520, 521 + 7, 5 * 521 + 300]  # buckets with gaps, and of hashes of every remainder
    lineitem = spark.createDataFrame([(h, 1, 1) for h in hashes], "l_partkey long, l_suppkey long, l_linenumber int")
    lineitem.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [r.bucket for r in QUERIES["list_buckets"](spark, str(tmp_path)).collect()] == [0, 1, 2, 5, 7, 300, 520]


def murmur(data: bytes, seed: int = 42) -> int:
    """The low half of MurmurHash3 x64 128, a byte string at a time."""
    m = (1 << 64) - 1
    rot = lambda x, n: ((x << n) | (x >> (64 - n))) & m
    c1, c2, h1, h2 = 0x87C37B91114253D5, 0x4CF5AD432745937F, seed, seed
    end = len(data) // 16 * 16
    for i in range(0, end, 16):
        k1, k2 = (int.from_bytes(data[j : j + 8], "little") for j in (i, i + 8))
        h1 ^= rot(k1 * c1 & m, 31) * c2 & m
        h1 = ((rot(h1, 27) + h2) * 5 + 0x52DCE729) & m
        h2 ^= rot(k2 * c2 & m, 33) * c1 & m
        h2 = ((rot(h2, 31) + h1) * 5 + 0x38495AB5) & m
    rest = data[end:]
    if len(rest) > 8:
        h2 ^= rot(int.from_bytes(rest[8:], "little") * c2 & m, 33) * c1 & m
    if rest:
        h1 ^= rot(int.from_bytes(rest[:8], "little") * c1 & m, 31) * c2 & m
    h1, h2 = h1 ^ len(data), h2 ^ len(data)
    h1 = (h1 + h2) & m
    h2 = (h2 + h1) & m

    def mix(k):
        k = (k ^ (k >> 33)) * 0xFF51AFD7ED558CCD & m
        k = (k ^ (k >> 33)) * 0xC4CEB9FE1A85EC53 & m
        return k ^ (k >> 33)

    return (mix(h1) + mix(h2)) & m


def test_sketch_murmur_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000").limit(40)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    samples: dict = {}
    for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect():
        data = r.text.encode()
        for k in (21, 31):
            for i in range(len(data) - k + 1):
                w = data[i : i + k]
                h = murmur(min(w, w[::-1]))
                if h < (1 << 64) // 200:
                    samples.setdefault((k, h), set()).add(r.source)
    got = {(r.ksize, r.hash & ((1 << 64) - 1)): (r.bucket, r.n_samples) for r in QUERIES["sketch_murmur"](spark, str(tmp_path)).collect()}
    assert got == {(k, h): (h % 521, len(s)) for (k, h), s in samples.items()} and len(got) > 50


def test_comparisons_keep_of_the_right_side_what_the_left_one_has(spark):
    """No hash that the left side lacks is grouped, moved or written, and each that it has comes with every sample."""
    from pyspark.sql import functions as F

    from hashloom.operators import sketch
    from hashloom.plans import queries

    left, right = queries._sides(spark, str(SF))
    every = sketch.sketch(queries.load(spark, str(SF), "documents"), "text", "source", (31,), 20, "md5_60").select("sample_id", "ksize", "hash").distinct()
    shared = every.join(left.select("ksize", "hash"), ["ksize", "hash"], "left_semi").select("sample_id", "ksize", "hash")
    got = right.select("sample_id", "ksize", "hash").distinct()
    assert right.join(left.select("ksize", "hash"), ["ksize", "hash"], "left_anti").isEmpty() and not every.join(left.select("ksize", "hash"), ["ksize", "hash"], "left_anti").isEmpty()
    assert shared.exceptAll(got).isEmpty() and got.exceptAll(shared).isEmpty()
    plan = right.groupBy("hash").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
