"""The work queue as keyed state with timers: a stream of events goes in, each change of what a file's row is comes out.

A file's last event is its state. An event that puts a row in progress starts a timer for when it is stale, one that
reports an error starts one for the end of its cool-down; when event time passes a timer, the row is PENDING
again, or can be claimed. State and timers are in the state store (RocksDB) and its checkpoint, so a stopped stream goes on from there, and an update touches
the files that have events or timers due and no others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.workqueue import IN_PROGRESS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "id long, url string, status string, tries int, at_ms long, version long"
CHANGES = "subdir string, filename string, id long, url string, status string, tries int, at_ms long, claimable boolean, version long"
EVENTS = "subdir string, filename string, id long, url string, status string, tries int, at_ms long, at timestamp"
TOLD = Row(*(c.split(" ")[0] for c in CHANGES.split(", ")))


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams that start inside keep their state in RocksDB: on disk and not in the executors' heap. The session's setting comes back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class QueueState(StatefulProcessor):
    """One file's row and its timer. stale, cooldown: seconds."""

    def __init__(self, stale: float, cooldown: float, cap: int):
        self.stale, self.cooldown, self.cap = int(stale * 1000), int(cooldown * 1000), cap

    def init(self, handle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", STATE)

    def _told(self, key, row: tuple, claimable: bool) -> Row:
        return TOLD(*key, *row[:5], claimable, row[5])

    def _wait(self, row: tuple) -> int | None:
        """When the row changes by itself, one millisecond after the last at which it doesn't."""
        status, tries, at = row[2], row[3], row[4]
        if status in IN_PROGRESS:
            return at + self.stale + 1
        return at + self.cooldown if status == "ERROR" and tries < self.cap else None

    def handleInputRows(self, key, rows, timerValues):
        found = self.row.get()
        was = None if found is None else tuple(found)
        best = was
        for e in rows:
            if best is None or (e.at_ms, e.id) > (best[4], best[0]) or (best is was and (e.at_ms, e.id) >= (was[4], was[0])):
                best = (e.id, e.url, e.status, e.tries, e.at_ms, (was[5] if was else 0) + 1)
        if best is was:
            return
        for due in list(self.handle.listTimers()) if was else ():
            self.handle.deleteTimer(due)
        now = int(timerValues.getCurrentWatermarkInMs())
        due = self._wait(best)
        claimable = best[2] == "PENDING"
        if due is not None and due <= now:  # an event whose time had passed when it came
            best, claimable = self._due(best, due)
        elif due is not None:
            self.handle.registerTimer(due)
        self.row.update(best)
        yield self._told(key, best, claimable)

    def _due(self, row: tuple, due: int) -> tuple[tuple, bool]:
        status = "PENDING" if row[2] in IN_PROGRESS else row[2]
        return (row[0], row[1], status, row[3], row[4] if status == "ERROR" else due, row[5] + 1), True

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        row = tuple(self.row.get())
        due = self._wait(row)
        if due is None or due > int(expiredTimerInfo.getExpiryTimeInMs()):
            return
        row, claimable = self._due(row, due)
        self.row.update(row)
        yield self._told(key, row, claimable)

    def close(self) -> None:
        return


#: Events that a worker holds at once.
HELD_EVENTS = 1 << 18


def _last(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The last event by (at, id) of each file, the first that came of equal ones."""
    events = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    names = [events.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy() for c in ("subdir", "filename")]
    at, numbers = events.column("at_ms").to_numpy(), pc.fill_null(events.column("id"), -(1 << 63)).to_numpy()
    order = np.lexsort((-np.arange(len(at)), numbers, at, names[1], names[0]))
    ends = np.append((names[0][order[1:]] != names[0][order[:-1]]) | (names[1][order[1:]] != names[1][order[:-1]]), True)
    return events.take(pa.array(order[ends]))


def _last_events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task has of a file as one event, or a few where it has more files than it may hold events; a row costs the state far more than it costs here."""
    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n >= HELD_EVENTS:
            held = [_last(held)]
            n = held[0].num_rows
            if n >= HELD_EVENTS // 2:
                yield held[0]
                held, n = [], 0
    if held:
        yield _last(held)


def queue_changes(events: DataFrame, stale: float = 3600, cooldown: float = 3600, cap: int = 20, late: str = "0 seconds") -> DataFrame:
    """The stream of changes (CHANGES) that a stream of events (subdir, filename, id, url, status, tries, at: event time) makes.

    Of one file's events the last by (at, id) counts. Event time is the clock: timers go off when it has passed them by ``late``, and an event
    later than that is dropped. ``version`` numbers a file's changes, so its row is the one with the greatest.
    Null names are a file like others; events without a time are left out. Of the events that arrive together only a file's last goes to the state.
    """
    timed = events.where("at IS NOT NULL").withColumn("at", F.col("at").cast("timestamp"))
    rows = timed.select("subdir", "filename", F.col("id").cast("long").alias("id"), "url", "status", F.col("tries").cast("int").alias("tries"), F.unix_millis("at").alias("at_ms"), "at")
    rows = rows.repartition("subdir", "filename").mapInArrow(_last_events, EVENTS).withWatermark("at", late)
    return rows.groupBy("subdir", "filename").transformWithState(QueueState(stale, cooldown, cap), CHANGES, "Append", "eventTime")


def run_changes(changes: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Takes up all events that have arrived, lets the timers that are due go off, and stops."""
    with rocksdb(changes.sparkSession):
        query = changes.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def queue_rows(changes: DataFrame) -> DataFrame:
    """The row of each file that its changes, as written, lead to."""
    rest = [c for c in changes.columns if c not in ("subdir", "filename")]
    last = changes.groupBy("subdir", "filename").agg(F.max_by(F.struct(*rest), "version").alias("r"))
    return last.select("subdir", "filename", *(f"r.{c}" for c in rest))
