"""Distinct hashes of bucket directories whose files are sorted, by merging: a data source whose plan has neither sort nor exchange.

A task takes whole buckets of all roots, about ``GROUP_BYTES`` of them, and merges a bucket's files, a batch of each in memory: what is no greater than the least of
the batches' last keys is complete and goes out, once. Collections of one modulus meet in the same buckets.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .archives import opened

FORMAT = "sorted_hashes"
#: Rows of a file in memory at once.
BATCH = 65_536
#: Bytes of files in a task, each counted for as many more as it costs to open one; a larger bucket is one by itself.
GROUP_BYTES, OPEN_BYTES = 128 << 20, 2 << 20


class Run:
    """A sorted file, a batch of (k sizes, hashes) at a time."""

    def __init__(self, path: str, by_ksize: bool, rows: int):
        store, at = opened(path)
        self.path, self.file = path, pq.ParquetFile(store.open_input_file(at))
        columns = ["ksize", "hash"] if by_ksize else ["hash"]
        if self.file.schema_arrow.field("hash").type != pa.int64():
            raise ValueError(f"{path}: a hash isn't a signed 64-bit value, so the file isn't in this order")
        self.batches = self.file.iter_batches(rows, columns=columns)
        self.k = self.h = np.zeros(0, np.int64)
        self.last = None
        self.fill()

    def fill(self) -> None:
        """The next batch, if this one is used up; what isn't sorted raises."""
        while not len(self.h):
            batch = next(self.batches, None)
            if batch is None:
                self.file.close()
                return
            self.h = batch.column(batch.num_columns - 1).to_numpy()
            self.k = batch.column(0).to_numpy().astype(np.int64) if batch.num_columns > 1 else np.zeros(len(self.h), np.int64)
            bad = (self.k[1:] < self.k[:-1]) | ((self.k[1:] == self.k[:-1]) & (self.h[1:] < self.h[:-1]))
            if bad.any() or (len(self.h) and self.last is not None and (int(self.k[0]), int(self.h[0])) < self.last):
                raise ValueError(f"{self.path} isn't sorted")
            if len(self.h):
                self.last = (int(self.k[-1]), int(self.h[-1]))

    def take(self, k: int, h: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows up to (k, h)."""
        start, end = np.searchsorted(self.k, k, "left"), np.searchsorted(self.k, k, "right")
        n = start + np.searchsorted(self.h[start:end], h, "right")
        out = self.k[:n], self.h[:n]
        self.k, self.h = self.k[n:], self.h[n:]
        self.fill()
        return out


def merged(runs: list[Run]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(k sizes, hashes), ascending and distinct, of sorted runs."""
    runs = [r for r in runs if len(r.h)]
    while runs:
        k, h = min((int(r.k[-1]), int(r.h[-1])) for r in runs)
        parts = [r.take(k, h) for r in runs]
        ks, hs = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.lexsort((hs, ks))
        ks, hs = ks[order], hs[order]
        new = np.ones(len(hs), bool)
        new[1:] = (ks[1:] != ks[:-1]) | (hs[1:] != hs[:-1])
        yield ks[new], hs[new]
        runs = [r for r in runs if len(r.h)]


@dataclass
class Buckets(InputPartition):
    paths: dict[int, list[str]]


class MergedReader(DataSourceReader):
    def __init__(self, options):
        self.roots = options["roots"].split("\n")
        self.by_ksize = options.get("byKsize", "true").lower() == "true"
        self.rows = int(options.get("batchRows", BATCH))

    def partitions(self) -> list[InputPartition]:
        found: dict[int, list[tuple[str, int]]] = {}
        for root in self.roots:
            store, at = opened(root)
            prefix = "file:" if isinstance(store, fs.LocalFileSystem) else root.split("://", 1)[0] + "://"
            for f in store.get_file_info(fs.FileSelector(at, recursive=True)):
                number = re.search(r"/bucket=([0-9]+)/[^/_.][^/]*\.parquet$", f.path)
                if f.is_file and number:
                    found.setdefault(int(number[1]), []).append((prefix + f.path, f.size))
        groups, room = [Buckets({})], GROUP_BYTES
        for n, files in sorted(found.items()):
            size = sum(s + OPEN_BYTES for _, s in files)
            if room < size and groups[-1].paths:
                groups.append(Buckets({}))
                room = GROUP_BYTES
            groups[-1].paths[n] = sorted(p for p, _ in files)
            room -= size
        return groups

    def read(self, partition: Buckets) -> Iterator[pa.RecordBatch]:
        for n, paths in partition.paths.items():
            for k, h in merged([Run(p, self.by_ksize, self.rows) for p in paths]):
                columns = {"ksize": pa.array(k, pa.int16())} if self.by_ksize else {}
                columns |= {"hash": pa.array(h), "bucket": pa.array(np.full(len(h), n), pa.int32())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


class MergedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "ksize smallint, hash long, bucket int" if self.options.get("byKsize", "true").lower() == "true" else "hash long, bucket int"

    def reader(self, schema) -> MergedReader:
        return MergedReader(self.options)


def read_merged(spark: SparkSession, *roots: str, by_ksize: bool = True, batch_rows: int = BATCH) -> DataFrame:
    """Distinct [ksize], hash, bucket of the bucket directories under all roots, whose files ``write_unique`` has sorted; sorted within a bucket.

    With ``by_ksize`` false the files must have no k column (or one k size), since their order is by k size first.
    """
    spark.dataSource.register(MergedSource)
    return spark.read.format(FORMAT).options(roots="\n".join(roots), byKsize=str(by_ksize).lower(), batchRows=batch_rows).load()
