"""Tables that a query writes and reads again, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Where that is unset, one of our own in local mode; on a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="hashloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Scratch:
    """Written Parquet tables in the shared folder, which also cut a plan from its lineage.

    ``drop(name)`` removes a table as soon as nothing reads it again; what is
    left at the end of the process goes then.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/hashloom-{name}-{uuid.uuid4().hex}"
        atexit.register(self._remove, self.root)

    def write(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = f"{self.root}/{name}"
        schema = df.schema
        df.write.option("compression", codec).parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, name: str) -> None:
        self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        sc = self.spark.sparkContext
        if sc._jsc is None:
            return
        try:
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may have ended before this process
            return


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared one; it goes at the end of the process."""
    return Scratch(spark, name).root
