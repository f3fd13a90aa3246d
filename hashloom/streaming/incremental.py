"""Incremental processing: deduplication of arriving hashes, and the queue as a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from ..functions import uint64
from .queue_timers import rocksdb


def occurrence_stream(spark: SparkSession, root: str, schema: StructType, max_files: int = 1000, glob: str = "*.parquet") -> DataFrame:
    """Files that arrive under root; ``max_files`` a micro-batch bounds what one takes in."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).option("pathGlobFilter", glob).option("recursiveFileLookup", True).parquet(root)


def dedup_stream(stream: DataFrame, keys=("ksize", "hash"), mod: int = 521) -> DataFrame:
    """The first row of each key over the stream's whole life, with its bucket; state holds keys alone."""
    return stream.select(*keys).dropDuplicates(list(keys)).withColumn("bucket", uint64.mod(F.col("hash"), mod))


def run_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Works through all that has arrived and stops; run again with the same checkpoint, it takes up what is new, once. State is in RocksDB."""
    with rocksdb(df.sparkSession):
        query = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def recount(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Distinct-sample counts over all that has arrived, in batch; ``count_stream`` keeps them up without reading old rows."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
    return rows.groupBy("ksize", "hash").agg(F.count_distinct("sample_id").alias("n_samples"))


def count_stream(occurrences: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Keeps the distinct-sample counts below root up to date with arriving occurrences; each micro-batch is a load, so a repeated one counts once."""
    from ..operators.counting import SampleCounts

    def take(batch: DataFrame, n: int) -> None:
        counts = SampleCounts(batch.sparkSession, root)
        counts.load(batch, f"{checkpoint} {n}")
        counts.compact()

    query = occurrences.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def queue_stream(events: DataFrame, state_path: str, checkpoint: str, key=("subdir", "filename")) -> StreamingQuery:
    """Keeps the latest event of each file in versions under state_path: each micro-batch merges with the version before and writes the next, so a repeated batch gives the same version."""
    from ..operators.workqueue import latest

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if n:
            rows = spark.read.parquet(f"{state_path}/v{n - 1}").unionByName(batch)
        latest(rows, list(key), F.col("updated_at").desc_nulls_last(), F.col("id").desc()).write.mode("overwrite").parquet(f"{state_path}/v{n}")

    query = events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class Progress(StreamingQueryListener):
    """Keeps the newest figures of every running query: rows in, rows a second, rows of state. Register with ``spark.streams.addListener``."""

    def __init__(self):
        self.latest: dict[str, dict] = {}

    def onQueryStarted(self, event):
        self.latest[str(event.id)] = {"batch": -1, "rows": 0, "rows_per_second": 0.0, "state_rows": 0, "running": True}

    def onQueryProgress(self, event):
        p = event.progress
        mine = self.latest.setdefault(str(p.id), {"rows": 0, "running": True})
        mine.update(batch=p.batchId, rows=mine["rows"] + p.numInputRows, rows_per_second=p.processedRowsPerSecond, state_rows=sum(s.numRowsTotal for s in p.stateOperators))

    def onQueryIdle(self, event):
        return

    def onQueryTerminated(self, event):
        self.latest.setdefault(str(event.id), {})["running"] = False
