"""The stored queue with several programs on it, restarts, and the queue as keyed state with timers."""

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hashloom import schema, tasks
from hashloom.operators import workqueue
from hashloom.sources import versions
from hashloom.streaming import queue_timers

NOW = 10_000.0


def pending(spark, n):
    return spark.createDataFrame([(i, "d", f"f{i}", f"u{i}", None, None, "PENDING", 0, None, None, None, 0.0) for i in range(1, n + 1)], schema.QUEUE)


def ids(df):
    return [r.id for r in df.orderBy("id").collect()]


def test_claimers_at_once_never_get_one_row_twice(spark, tmp_path):
    stores = [workqueue.QueueStore(spark, str(tmp_path)) for _ in range(4)]
    assert [s.start(pending(spark, 100)) for s in stores] == [True, False, False, False]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda s: ids(s.claim(15, NOW)), stores))
    assert sorted(i for part in got for i in part) == list(range(1, 61)) and all(len(part) == 15 for part in got)
    assert stores[0].state().where("status = 'DOWNLOADING'").count() == 60


def test_the_loser_of_a_claim_tries_again(spark, tmp_path, monkeypatch):
    one, other = (workqueue.QueueStore(spark, str(tmp_path)) for _ in range(2))
    one.start(pending(spark, 10))
    stage, seen = one.table.stage, []

    def staged(df):
        part = stage(df)
        seen.append(part)
        if len(seen) == 1:  # the other one commits between this one's read and its commit
            assert ids(other.claim(3, NOW)) == [1, 2, 3]
        return part

    monkeypatch.setattr(one.table, "stage", staged)
    assert ids(one.claim(3, NOW)) == [4, 5, 6] and len(seen) == 2
    assert one.table.version() == 2


def test_marks_of_two_programs_and_tidying(spark, tmp_path):
    one, other = (workqueue.QueueStore(spark, str(tmp_path), parts=4) for _ in range(2))
    one.start(pending(spark, 8))
    change = "id long, status string, out_path string, last_error string, inc_tries boolean"
    for k, store in enumerate((one, other, one, other)):
        claimed = ids(store.claim(2, NOW + k))
        store.mark(spark.createDataFrame([(claimed[0], "DONE", "/o", None, False), (claimed[1], "ERROR", None, "bad", True)], change), NOW + k)
    got = {r.id: (r.status, r.tries, r.out_path, r.last_error) for r in one.state().collect()}
    assert got == {i: ("DONE", 0, "/o", None) if i % 2 else ("ERROR", 1, None, "bad") for i in range(1, 9)}
    assert len(one.table.snapshot()["parts"]) < 4  # parts are merged
    assert len(list((tmp_path / "versions").glob("*.json"))) <= 3  # and old versions removed
    assert ids(one.claim(5, NOW)) == []  # errors cool down
    assert len(ids(one.claim(5, NOW + 4000))) == 4


def test_a_stopped_program_goes_on(spark, tmp_path):
    root, calls = str(tmp_path / "queue"), []

    def work(todo):
        calls.append(ids(todo))
        if len(calls) == 2:
            raise RuntimeError("the program is stopped in its second round")
        return todo.select("id", F.lit("/o").alias("out_path"), F.lit(None).cast("string").alias("error"))

    with pytest.raises(RuntimeError):
        workqueue.run_queue(pending(spark, 9), root, 4, work, clock=lambda: NOW)
    assert calls == [[1, 2, 3, 4], [5, 6, 7, 8]]
    # at once: what it had in progress isn't stale, the rest goes on
    state, totals = workqueue.run_queue(None, root, 4, work, clock=lambda: NOW + 1, spark=spark)
    assert calls[2:] == [[9]] and totals["done"] == 1
    # later: its rows are taken back; the first state isn't taken again
    state, totals = workqueue.run_queue(pending(spark, 9), root, 4, work, clock=lambda: NOW + 5000)
    assert calls[3:] == [[5, 6, 7, 8]] and totals == {"done": 4, "skipped": 0, "error": 0}
    assert {r.status for r in state.collect()} == {"DONE"} and state.count() == 9
    assert workqueue.run_queue(None, root, 4, work, clock=lambda: NOW + 5001)[1]["done"] == 0


def test_counts_show_the_first_errors(spark):
    rows = [(i, None, f"e{i}", "error", 1) for i in range(30, 0, -1)] + [(i, "/o", None, "done", 0) for i in range(40, 45)]
    got = {r.outcome: (r.n, r.examples) for r in workqueue.outcome_counts(spark.createDataFrame(rows, "id long, out_path string, error string, outcome string, failures int")).collect()}
    assert got == {"error": (30, [f"e{i}" for i in range(1, workqueue.EXAMPLES + 1)]), "done": (5, [])}
    plan = workqueue.outcome_counts(spark.createDataFrame(rows, "id long, out_path string, error string, outcome string, failures int"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_tasks_of_a_stored_queue_follow_its_bytes(spark, tmp_path, monkeypatch):
    store = workqueue.QueueStore(spark, str(tmp_path))
    store.start(pending(spark, 3000))
    monkeypatch.setattr(versions, "NEWEST_BYTES", 1000)
    asked = tasks.needed(store.table.read(seq=True), 1000)
    state = store.state()
    assert state.rdd.getNumPartitions() == asked > int(spark.conf.get("spark.sql.shuffle.partitions")) and state.count() == 3000
    plan = state._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in plan[plan.index("REPARTITION_BY_NUM") :]  # nothing is sorted before it is dealt


def test_a_change_commits_the_rows_that_differ(spark, tmp_path):
    store = workqueue.QueueStore(spark, str(tmp_path))
    store.start(pending(spark, 6).withColumn("last_error", F.when(F.col("id") == 4, "old")))

    def change(state):
        more = pending(spark, 9).where("id = 9")
        return state.withColumn("last_error", F.when(F.col("id") == 2, "x")).unionByName(more)

    before = set(store.table.snapshot()["parts"])
    store.apply(change)
    (part,) = set(store.table.snapshot()["parts"]) - before
    got = {r.id: r.last_error for r in spark.read.schema(schema.QUEUE).parquet(f"{tmp_path}/data/{part}").collect()}
    assert got == {2: "x", 4: None, 9: None} and ids(store.state()) == [1, 2, 3, 4, 5, 6, 9]
    store.apply(lambda state: state)
    assert ids(store.state()) == [1, 2, 3, 4, 5, 6, 9]


EVENTS = "subdir string, filename string, id long, url string, status string, tries int, at timestamp"


def stream_rows(spark, root):
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    queue_timers.run_changes(queue_timers.queue_changes(events, stale=600, cooldown=300, cap=5, late="50 seconds"), f"{root}/changes", f"{root}/checkpoint")
    return queue_timers.queue_rows(spark.read.parquet(f"{root}/changes"))


def batch_rows(spark, events, now):
    """The batch functions over the same events."""
    at = F.unix_millis("at") / 1000
    null = F.lit(None).cast("string")
    rows = events.where("at IS NOT NULL").select(
        "id", "subdir", "filename", "url", F.lit(None).cast("long").alias("size"), null.alias("mtime"), "status", "tries", null.alias("last_error"), null.alias("out_path"), at.alias("updated_at"), F.lit(0.0).alias("created_at")
    )
    last = workqueue.latest(rows, ["subdir", "filename"], F.col("updated_at").desc(), F.col("id").desc())
    state = workqueue.reset_stuck(last, now, 600)
    return state.withColumn("claimable", workqueue.claim_order(now, 300, 5)[0])


def test_timers_do_what_the_batch_functions_do(spark, tmp_path):
    """Events in three runs, each from the checkpoint of the one before; after each the rows are those of a batch over all events so far."""
    rng = random.Random(2)
    everything, clock, kinds = [], 1_000_000, set()
    for run in range(3):
        rows = []
        for _ in range(40):
            clock += rng.randrange(40)
            name = rng.choice([None, *(f"f{i}" for i in range(30))])
            rows.append(("d", name, len(everything) + len(rows), "u", rng.choice(["PENDING", "DOWNLOADING", "SKETCHING", "ERROR", "ERROR", "DONE"]), rng.randrange(7), clock - rng.randrange(50)))
        rows.append(("d", "clock", len(everything) + len(rows), "u", "DONE", 0, clock))
        everything += rows
        for part in (rows[:20], rows[20:]):
            df = spark.createDataFrame(part, EVENTS.replace("at timestamp", "at long")).withColumn("at", F.timestamp_seconds("at"))
            df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        got = {(r.subdir, r.filename): (r.id, r.status, r.tries, r.claimable) for r in stream_rows(spark, tmp_path).collect()}
        events = spark.createDataFrame(everything, EVENTS.replace("at timestamp", "at long")).withColumn("at", F.timestamp_seconds("at"))
        want = {(r.subdir, r.filename): (r.id, r.status, r.tries, r.claimable) for r in batch_rows(spark, events, float(clock - 50)).collect()}
        assert got == want, run
        kinds |= {(status, claimable) for _, status, _, claimable in got.values()}
    assert {("PENDING", True), ("ERROR", True), ("ERROR", False), ("DONE", False)} <= kinds


def test_the_state_gets_one_event_a_file(monkeypatch):
    """A file's last event of those that a task has; several only where its files are more than it may hold, and then none that counts is missing."""
    rng, events = random.Random(5), []
    for i in range(4000):
        name = rng.choice([None, "", *(f"f{k}" for k in range(60))])
        at = rng.randrange(50)
        events.append({"subdir": rng.choice([None, "d"]), "filename": name, "id": rng.choice([None, i // 2]), "url": f"u{i}", "status": "DONE", "tries": 1, "at_ms": at, "at": datetime.fromtimestamp(at, UTC)})
    types = pa.schema([(c, t) for c, t in zip(events[0], [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.timestamp("us", "UTC")], strict=True)])
    batches = [pa.RecordBatch.from_pylist(events[k : k + 100], types) for k in range(0, 4000, 100)]
    want = {}
    for e in events:
        key, order = (e["subdir"], e["filename"]), (e["at_ms"], -1 if e["id"] is None else e["id"])
        if key not in want or order > want[key][0]:
            want[key] = (order, e["url"])
    got = [r for b in queue_timers._last_events([*batches[:3], batches[0][:0], *batches[3:]]) for r in b.to_pylist()]
    assert sorted(map(str, ((r["subdir"], r["filename"], r["url"]) for r in got))) == sorted(map(str, ((*k, u) for k, (_, u) in want.items())))
    monkeypatch.setattr(queue_timers, "HELD_EVENTS", 150)
    some = {r["url"] for b in queue_timers._last_events(batches) for r in b.to_pylist()}
    assert {u for _, u in want.values()} <= some and len(some) < 4000
    assert list(queue_timers._last_events([])) == []


def test_rocksdb_setting_comes_back(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    with queue_timers.rocksdb(spark):
        assert spark.conf.get(key) == queue_timers.ROCKSDB
    assert spark.conf.get(key, None) == before
