"""The work queue as pure functions: (state, changes, now) to a new state.

State has the columns of ``schema.QUEUE``, one row per (subdir, filename). ``now`` is a parameter, which makes every step
repeatable. ``QueueStore`` keeps a state in a folder for programs that claim and mark at once.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import QUEUE
from ..scratch import Scratch
from ..sources.versions import Conflict, VersionedTable, newest
from .dedup import ranked

IN_PROGRESS = ("DOWNLOADING", "SKETCHING")
UNFINISHED = ("PENDING", "ERROR", "DOWNLOADING", "SKETCHING")
#: Errors that a round or a program reports.
EXAMPLES = 20


def upsert(state: DataFrame, files: DataFrame, now: float) -> DataFrame:
    """State with ``files`` (subdir, filename, url, size, mtime; unique keys) added as PENDING; known files get the new facts, and keep status and tries.

    New ids go on from the largest, in the order of (subdir, filename).
    """
    key = ["subdir", "filename"]
    new = files.join(state.select(*key), key, "left_anti")
    last = state.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    added = new.join(ranked(new, *key), key).select(
        (F.col("_place") + (last + 1)).cast("bigint").alias("id"), *key, "url", F.col("size").cast("bigint").alias("size"), "mtime",
        F.lit("PENDING").alias("status"), F.lit(0).alias("tries"), F.lit(None).cast("string").alias("last_error"), F.lit(None).cast("string").alias("out_path"),
        F.lit(now).cast("double").alias("updated_at"), F.lit(now).cast("double").alias("created_at"),
    )
    seen = files.select(*key, F.col("url").alias("_u"), F.col("size").alias("_s"), F.col("mtime").alias("_m"), F.lit(True).alias("_hit"))
    hit = F.col("_hit").isNotNull()
    kept = state.join(seen, key, "left").select(
        "id", *key, F.when(hit, F.col("_u")).otherwise(F.col("url")).alias("url"), F.when(hit, F.col("_s")).otherwise(F.col("size")).cast("bigint").alias("size"),
        F.when(hit, F.col("_m")).otherwise(F.col("mtime")).alias("mtime"), "status", "tries", "last_error", "out_path",
        F.when(hit, F.lit(now)).otherwise(F.col("updated_at")).cast("double").alias("updated_at"), "created_at",
    )
    return kept.unionByName(added)


def claim_order(now: float, cooldown: float = 3600, cap: int = 20) -> tuple[Column, list[Column]]:
    """(which rows can be claimed, in what order): PENDING by id, then ERROR below the cap and cooled down, the longest waiting first."""
    ready = (F.col("status") == "ERROR") & (F.col("tries") < cap) & (F.col("updated_at").isNull() | (F.col("updated_at") <= now - cooldown))
    pending = F.col("status") == "PENDING"
    order = [F.when(pending, 0).otherwise(1).asc(), F.when(pending, F.lit(None).cast("double")).otherwise(F.col("updated_at")).asc_nulls_first(), F.col("id").asc()]
    return pending | ready, order


def claim(state: DataFrame, n: int, now: float, cooldown: float = 3600, cap: int = 20) -> tuple[DataFrame, DataFrame]:
    """(the next n rows to work on, the state with these DOWNLOADING)."""
    can, order = claim_order(now, cooldown, cap)
    chosen = state.where(can).orderBy(*order).limit(n).select("id", "subdir", "filename", "url")
    hit = chosen.select("id", F.lit(True).alias("_hit"))
    marked = state.join(hit, "id", "left")
    got = F.col("_hit").isNotNull()
    return chosen, marked.withColumn("status", F.when(got, "DOWNLOADING").otherwise(F.col("status"))).withColumn("updated_at", F.when(got, F.lit(float(now))).otherwise(F.col("updated_at"))).drop("_hit").select(*state.columns)


def mark(state: DataFrame, changes: DataFrame, now: float) -> DataFrame:
    """State after ``changes`` (id, status, out_path, last_error, inc_tries; unique ids): output and error are overwritten, also by null; inc_tries is whether to count a try, or how many."""
    c = changes.select("id", F.col("status").alias("_st"), F.col("out_path").alias("_o"), F.col("last_error").alias("_e"), F.col("inc_tries").alias("_t"))
    hit = F.col("_st").isNotNull()
    new = {
        "status": F.when(hit, F.col("_st")).otherwise(F.col("status")),
        "out_path": F.when(hit, F.col("_o")).otherwise(F.col("out_path")),
        "last_error": F.when(hit, F.col("_e")).otherwise(F.col("last_error")),
        "tries": F.col("tries") + F.when(hit, F.coalesce(F.col("_t").cast("int"), F.lit(0))).otherwise(0),
        "updated_at": F.when(hit, F.lit(float(now))).otherwise(F.col("updated_at")),
    }
    return state.join(c, "id", "left").withColumns(new).select(*state.columns)


def latest(events: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The last event of each key: the state that an append-only log stands for."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return events.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def is_stuck(now: float, stale: float = 3600) -> Column:
    """Which rows are in progress without a change since ``now - stale`` (or without a time)."""
    return F.col("status").isin(*IN_PROGRESS) & (F.col("updated_at").isNull() | (F.col("updated_at") < now - stale))


def reset_stuck(state: DataFrame, now: float, stale: float = 3600) -> DataFrame:
    """Stuck rows are PENDING again; tries stay."""
    stuck = is_stuck(now, stale)
    return state.withColumns({"status": F.when(stuck, "PENDING").otherwise(F.col("status")), "updated_at": F.when(stuck, F.lit(float(now))).otherwise(F.col("updated_at"))})


def verify(state: DataFrame, probes: DataFrame, now: float) -> DataFrame:
    """PENDING rows whose probe (url, code) isn't 200, or is missing, become ERROR; tries stay."""
    p = probes.select("url", F.col("code").alias("_code"))
    bad = (F.col("status") == "PENDING") & (F.coalesce(F.col("_code"), F.lit(0)) != 200)
    text = F.concat(F.lit("probe: "), F.coalesce(F.col("_code").cast("string"), F.lit("no answer")))
    new = {"last_error": F.when(bad, text).otherwise(F.col("last_error")), "updated_at": F.when(bad, F.lit(float(now))).otherwise(F.col("updated_at")), "status": F.when(bad, "ERROR").otherwise(F.col("status"))}
    return state.join(p, "url", "left").withColumns(new).select(*state.columns)


def stats(state: DataFrame) -> DataFrame:
    """(status, n) of the statuses that occur, and the total as status ``total``."""
    return state.rollup("status").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("status", F.lit("total")).alias("status"), "n")


def pending_work(state: DataFrame) -> DataFrame:
    """(n): rows whose status isn't final."""
    return state.agg(F.count_if(F.col("status").isin(*UNFINISHED)).alias("n"))


def unfinished(state: DataFrame, limit: int = 100) -> DataFrame:
    return state.where(F.col("status").isin(*UNFINISHED)).orderBy("id").limit(limit).select("id", "subdir", "filename", "url", "status")


def next_batch(state: DataFrame, limit: int = 1000, after: int = -1) -> DataFrame:
    """PENDING and ERROR rows by id; ``after`` is the last id of the page before, so changes between pages skip nothing."""
    return state.where(F.col("status").isin("PENDING", "ERROR") & (F.col("id") > after)).orderBy("id").limit(limit).select("id", "subdir", "filename", "url")


def is_drained(state: DataFrame, now: float, cooldown: float = 3600, cap: int = 20) -> bool:
    """Whether nothing is in progress and nothing can be claimed now or after a cool-down."""
    can_later = F.col("status").isin("PENDING", *IN_PROGRESS) | ((F.col("status") == "ERROR") & (F.col("tries") < cap))
    return state.where(can_later).isEmpty()


def not_done(files: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Files without an output yet."""
    return files.join(done.select(*key), key, "left_anti")


def pending(state: DataFrame, limit: int = 1000, after: int = -1) -> DataFrame:
    """PENDING rows by id, a page at a time by the last id of the page before."""
    return state.where((F.col("status") == "PENDING") & (F.col("id") > after)).orderBy("id").limit(limit).select("id", "subdir", "filename", "url")


def _worked(chosen: DataFrame, work: Callable[[DataFrame], DataFrame], done: DataFrame | None, attempts: int) -> DataFrame:
    """(id, out_path, error, outcome, failures) of claimed rows, after all attempts; see ``run_batch``."""
    scratch = Scratch(chosen.sparkSession, "batch")
    key = ["subdir", "filename"]
    outcome = "id long, out_path string, error string, outcome string, failures int"
    outcomes = chosen.sparkSession.createDataFrame([], outcome)
    todo = chosen
    if done is not None:
        todo = chosen.join(done.select(*key), key, "left_anti").select(*chosen.columns)
        had = chosen.join(done.select(*key, "out_path"), key)
        outcomes = outcomes.unionByName(had.select("id", "out_path", F.lit(None).cast("string").alias("error"), F.lit("skipped").alias("outcome"), F.lit(0).alias("failures")))
    for attempt in range(attempts):
        got = work(todo).select("id", F.col("out_path").cast("string"), F.col("error").cast("string"), F.lit(True).alias("_back"))
        failed = F.col("error").isNotNull() | F.col("_back").isNull()
        tried = scratch.write(todo.join(got, "id", "left").withColumn("_failed", failed), f"tried{attempt}")
        last = attempt == attempts - 1
        ended = tried if last else tried.where("NOT _failed")
        bad = F.col("_failed")
        outcomes = outcomes.unionByName(
            ended.select(
                "id", F.when(~bad, F.col("out_path")).alias("out_path"), F.when(bad, F.coalesce("error", F.lit("no result"))).alias("error"),
                F.when(bad, "error").otherwise("done").alias("outcome"), (F.lit(attempt) + bad.cast("int")).alias("failures"),
            )
        )
        todo = tried.where("_failed").select(*chosen.columns)
        if last or todo.isEmpty():
            break
    return outcomes


def _changes(outcomes: DataFrame) -> DataFrame:
    """What ``mark`` takes of outcomes."""
    return outcomes.select("id", F.when(F.col("outcome") == "error", "ERROR").otherwise("DONE").alias("status"), "out_path", F.col("error").alias("last_error"), F.col("failures").alias("inc_tries"))


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """(outcome, n, examples): examples are the errors of up to EXAMPLES rows, those with the smallest ids, in their order.

    Each task passes on its first EXAMPLES of an outcome, so an outcome that all rows share is the work of all tasks.
    """
    counts = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    first = outcomes.where("error IS NOT NULL").withColumn("_place", F.row_number().over(Window.partitionBy("outcome").orderBy("id"))).where(F.col("_place") <= EXAMPLES)
    shown = first.groupBy("outcome").agg(F.array_sort(F.collect_list(F.struct("_place", "error"))).alias("_shown"))
    empty = F.expr("cast(array() AS array<string>)")
    return counts.join(shown, "outcome", "left").select("outcome", "n", F.coalesce(F.col("_shown.error"), empty).alias("examples"))


def run_batch(
    state: DataFrame, n: int, now: float, work: Callable[[DataFrame], DataFrame], done: DataFrame | None = None, cooldown: float = 3600, cap: int = 20, attempts: int = 1
) -> tuple[DataFrame, DataFrame]:
    """One round of the worker loop over all executors: (the new state, counts by outcome).

    Claims n rows; those whose output is in ``done`` (subdir, filename, out_path) are DONE without work; ``work``
    takes the others (id, subdir, filename, url) and gives (id, out_path, error), where a
    null error is success; what fails is given to it again, ``attempts`` times in all. Every failed attempt counts
    as a try; a row that ``work`` doesn't return has failed too. What work returns is written before it is used, so it is
    done once.
    counts: outcome (done, skipped, error), n, and the errors of up to EXAMPLES rows, those with the smallest ids, in ``examples``.
    """
    chosen, claimed = claim(state, n, now, cooldown, cap)
    outcomes = _worked(Scratch(state.sparkSession, "batch").write(chosen, "chosen"), work, done, attempts)
    return mark(claimed, _changes(outcomes), now), outcome_counts(outcomes)


class QueueStore:
    """A queue below a folder that several programs work on at once, without a lock and without one that must stay alive.

    A change of state is a part with the changed rows alone, committed as the next version; the row of an id with the newest
    version counts. Two programs that claim at once read the same version, and one of them commits; the other finds the version taken, reads
    again and claims other rows. Parts are merged after ``parts`` of them, old versions are removed.
    """

    def __init__(self, spark: SparkSession, root: str, parts: int = 16):
        self.spark, self.parts, self.table = spark, parts, VersionedTable(spark, root)

    def start(self, state: DataFrame) -> bool:
        """Puts the first state; False, and nothing changes, if the folder has one."""
        if self.table.version() >= 0:
            return False
        base = self.table.snapshot()
        try:
            self.table.commit(base, {self.table.stage(state.select(*QUEUE.names)): 0}, QUEUE)
        except Conflict:
            return False
        return True

    def state(self) -> DataFrame:
        return newest(self.table.read(seq=True), "id")

    def apply(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """Commits the rows that ``change`` makes different in the state (rows with the columns of the queue)."""

        def changed(rows: DataFrame, _: dict) -> DataFrame:
            was = newest(rows, "id")
            before = was.select("id", F.struct(*QUEUE.names).alias("_was"))
            made = change(was).select(*QUEUE.names).join(before, "id", "left")
            return made.where(~F.struct(*QUEUE.names).eqNullSafe(F.col("_was"))).select(*QUEUE.names)

        version = self.table.update(changed)
        self._tidy()
        return version

    def claim(self, n: int, now: float, cooldown: float = 3600, cap: int = 20, tries: int = 50) -> DataFrame:
        """The next n rows (id, subdir, filename, url), DOWNLOADING from now on and claimed by nobody else; fewer or none if there are no more."""
        for _ in range(tries):
            base = self.table.snapshot()
            rows = newest(self.table.read(base, seq=True), "id")
            can, order = claim_order(now, cooldown, cap)
            taken = rows.where(can).orderBy(*order).limit(n).withColumns({"status": F.lit("DOWNLOADING"), "updated_at": F.lit(float(now))}).select(*QUEUE.names)
            part = self.table.stage(taken)
            mine = self.spark.read.schema(QUEUE).parquet(f"{self.table.folder.root}/data/{part}").select("id", "subdir", "filename", "url")
            if mine.isEmpty():
                return mine
            try:
                self.table.commit(base, {**base["parts"], part: base["version"] + 1}, QUEUE)
            except Conflict:
                continue
            return Scratch(self.spark, "claimed").write(mine, "rows")
        raise Conflict(f"{tries} claimers were faster")

    def mark(self, changes: DataFrame, now: float) -> int:
        """``mark`` of the state; rows of other programs' changes stay as they are."""

        def changed(rows: DataFrame, _: dict) -> DataFrame:
            mine = rows.join(changes.select("id"), "id", "left_semi").select(rows.columns)
            return mark(newest(mine, "id"), changes, now).select(*QUEUE.names)

        version = self.table.update(changed)
        self._tidy()
        return version

    def reset_stuck(self, now: float, stale: float = 3600) -> int:
        """``reset_stuck`` of the state: rows that a program left in progress can be claimed again."""

        def changed(rows: DataFrame, _: dict) -> DataFrame:
            return reset_stuck(newest(rows, "id").where(is_stuck(now, stale)), now, stale).select(*QUEUE.names)

        version = self.table.update(changed)
        self._tidy()
        return version

    def _tidy(self) -> None:
        before = self.table.version()
        if self.table.compact(lambda rows: newest(rows, "id"), self.parts) != before:
            self.table.vacuum()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The state in a folder: of a ``QueueStore``, or of plain Parquet files."""
    store = QueueStore(spark, path)
    return store.state() if store.table.version() >= 0 else spark.read.schema(QUEUE).parquet(path)


def run_queue(
    state: DataFrame | None, root: str, n: int, work: Callable[[DataFrame], DataFrame], done: Callable[[], DataFrame] | None = None, clock: Callable[[], float] = time.time,
    cooldown: float = 3600, cap: int = 20, attempts: int = 1, most_rounds: int | None = None, stale: float = 3600, spark: SparkSession | None = None,
) -> tuple[DataFrame, dict[str, int]]:
    """The worker loop: claim, work (see ``run_batch``) and mark, round by round, until no row can be claimed now; (the last state, rows by outcome).

    The state is a ``QueueStore`` at ``root``: ``state`` starts it, and is left aside (or None) where the folder has one, so a program that
    stopped goes on from what it had committed, and several programs may run on one folder. Rows that a stopped one left in
    progress are claimed again after ``stale`` seconds. Rows that cool down are left for a later call; is_drained tells whether there are any.
    """
    store = QueueStore(spark or (state.sparkSession if state is not None else SparkSession.active()), root)
    if state is not None:
        store.start(state)
    store.reset_stuck(clock(), stale)
    totals, k = {"done": 0, "skipped": 0, "error": 0}, 0
    while most_rounds is None or k < most_rounds:
        now = clock()
        chosen = store.claim(n, now, cooldown, cap)
        if chosen.isEmpty():
            break
        k += 1
        outcomes = Scratch(store.spark, "outcomes").write(_worked(chosen, work, done() if done else None, attempts), "outcomes")
        store.mark(_changes(outcomes), now)
        for r in outcomes.groupBy("outcome").count().collect():
            totals[r["outcome"]] += r["count"]
    return store.state(), totals
