"""Sketch archives as a Spark data source: ``spark.read.format("sigzip")`` and ``df.write.format("sigzip")``.

Reading: a task takes a group of archives of about ``groupBytes`` and streams them. An archive is opened where it lies, entry by entry, and is never
a value in memory; of an entry over ``streamBytes`` not even the text is: its arrays of hashes are passed over once for the record around
them, and once more for the hashes, a megabyte at a time. Conditions on ksize are taken over by the reader.

Writing: tasks write archives into a folder of the job's. Commit moves them to their places and removes that folder; abort removes the
folder, with what tasks that were killed in the middle have left in it.
"""

from __future__ import annotations

import gzip
import io
import json
import posixpath
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from ..functions import names, uint64
from .archives import ENTRY_ENDS, FAULTS, LOG, RUN, ArchiveWriter, k_size, opened, signatures

FORMAT = "sigzip"
#: Bytes of archives in a task, and of an entry's text that is parsed as a whole.
GROUP_BYTES, STREAM_BYTES = 128 << 20, 64 << 20
#: Bytes of an entry in memory at once beyond that.
CHUNK = 1 << 20
ARRAY = re.compile(rb'(?<!\\)"(mins|hashes)"\s*:\s*\[')
#: The longest beginning of an array's name, blanks included, that is looked for across chunks.
REACH = 256
SIGNED = 1 << 63


def _signed(values: list) -> np.ndarray:
    """Whole numbers as signed 64-bit values of the same bits; what is none raises."""
    return np.array([int(v) & 0xFFFFFFFFFFFFFFFF for v in values], np.uint64).view(np.int64)


def _numbers(text: bytes) -> list:
    """The values of a piece of an array, without its brackets."""
    try:
        return [int(x) for x in text.split(b",")] if text.strip() else []
    except ValueError:
        return json.loads(b"[" + text + b"]")


def _scan(stream, around: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(number of the array, piece of its text) of the arrays of hashes in an entry; the text around them is added to ``around``, each array there holding its number."""
    held, number, inside = b"", -1, False
    while True:
        block = stream.read(CHUNK)
        held += block
        while True:
            if inside:
                end = held.find(b"]")
                cut = end if end >= 0 else held.rfind(b",") if block else len(held)
                if cut > 0:
                    yield number, held[:cut]
                    held = held[cut + (end < 0) :]
                if end < 0:
                    break
                held, inside = held[held.find(b"]") :], False
            found = ARRAY.search(held)
            if found is None:
                keep = min(REACH, len(held)) if block else 0
                around.append(held[: len(held) - keep])
                held = held[len(held) - keep :]
                break
            number, inside = number + 1, True
            around.append(held[: found.end()] + b"%d" % number)
            held = held[found.end() :]
        if not block:
            return


def large_entry(reopen, wanted: frozenset[int], failfast: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(k size, run of hashes) of an entry too large to hold; reopen() gives its stream from the start.

    A first pass keeps the records without their hashes, which tells each array's k size; the second passes the hashes on.
    """
    around: list[bytes] = []
    with reopen() as stream:
        for _ in _scan(stream, around):
            pass
    k_of = {}
    for s in signatures(b"".join(around), failfast):
        number = s.get("mins") if s.get("mins") is not None else s.get("hashes")
        if isinstance(number, list) and number and (not wanted or k_size(s) in wanted):
            k_of[number[0]] = k_size(s)
    with reopen() as stream:
        for number, piece in _scan(stream, []):
            if number in k_of:
                values = _numbers(piece)
                for i in range(0, len(values), RUN):
                    yield k_of[number], _whole_before_fault(k_of[number], values[i : i + RUN], failfast)


def small_entry(payload: bytes, wanted: frozenset[int], failfast: bool) -> Iterator[tuple[int, np.ndarray]]:
    """The same of an entry's whole text."""
    for s in signatures(payload, failfast):
        k = k_size(s)
        values = s.get("mins") if s.get("mins") is not None else s.get("hashes")
        if isinstance(values, list) and (not wanted or k in wanted):
            for i in range(0, len(values), RUN):
                yield k, _whole_before_fault(k, values[i : i + RUN], failfast)


class Cut(Exception):
    """A value that is no whole number, and what stood before it."""

    def __init__(self, k: int, before: np.ndarray):
        super().__init__("a hash is no whole number")
        self.k, self.before = k, before


def _whole_before_fault(k: int, values: list, failfast: bool) -> np.ndarray:
    try:
        return _signed(values)
    except FAULTS as e:
        if failfast:
            raise
        fine = []
        for v in values:
            try:
                fine.append(int(v))
            except FAULTS:
                break
        raise Cut(k, _signed(fine)) from e


def archive_runs(path: str, wanted: frozenset[int], failfast: bool, stream_bytes: int) -> Iterator[tuple[int, np.ndarray]]:
    """(k size, run of hashes) of an archive, as ``archives.occurrences`` has them of its bytes: faults skip an entry, or end the archive, or raise."""
    store, at = opened(path)
    try:
        with store.open_input_file(at) as file, zipfile.ZipFile(file) as archive:
            for info in archive.infolist():
                name = info.filename.lower()
                if info.is_dir() or not name.endswith(ENTRY_ENDS):
                    continue
                packed = name.endswith(".gz")

                def reopen(info=info, packed=packed):
                    return gzip.open(archive.open(info)) if packed else archive.open(info)

                try:
                    with reopen() as stream:
                        head = stream.read(stream_bytes + 1)
                    if len(head) <= stream_bytes:
                        runs = small_entry(head, wanted, failfast)
                    else:
                        del head
                        runs = large_entry(reopen, wanted, failfast)
                    yield from runs
                except (gzip.BadGzipFile, EOFError, zlib.error) as e:
                    if failfast or not packed:
                        raise
                    LOG.warning("entry %s skipped: %s", info.filename, e)
    except Cut as e:
        LOG.warning("archive cut short: %s", e)
        if len(e.before):
            yield e.k, e.before
    except FAULTS as e:
        if failfast:
            raise
        LOG.warning("archive cut short: %s", e)


@dataclass
class Group(InputPartition):
    paths: list[str]


class SigzipReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.end = options.get("suffix", ".sig.zip")
        self.group_bytes, self.stream_bytes = int(options.get("groupBytes", GROUP_BYTES)), int(options.get("streamBytes", STREAM_BYTES))
        self.failfast = options.get("mode", "permissive").lower() == "failfast"
        self.ksizes: frozenset[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """k sizes that are asked for by = or IN are the reader's; Spark keeps the other conditions."""
        for f in filters:
            if isinstance(f, EqualTo | In) and f.attribute == ("ksize",):
                asked = frozenset([f.value] if isinstance(f, EqualTo) else f.value)
                self.ksizes = asked if self.ksizes is None else self.ksizes & asked
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Archives in groups of about group_bytes; a larger one by itself."""
        store, at = opened(self.root)
        prefix = "file:" if isinstance(store, fs.LocalFileSystem) else self.root.split("://", 1)[0] + "://"
        listed = sorted((f.path, f.size) for f in store.get_file_info(fs.FileSelector(at, recursive=True)) if f.is_file and f.path.endswith(self.end))
        groups: list[Group] = []
        room = 0
        for path, size in listed:
            if room < size or not groups:
                groups.append(Group([]))
                room = self.group_bytes
            groups[-1].paths.append(prefix + path)
            room -= size
        return groups or [Group([])]

    def read(self, partition: Group) -> Iterator[pa.RecordBatch]:
        if self.ksizes is not None and not self.ksizes:
            return
        for path in partition.paths:
            for k, values in archive_runs(path, self.ksizes or frozenset(), self.failfast, self.stream_bytes):
                columns = [pa.array([path] * len(values)), pa.array(np.full(len(values), k), pa.int32()), pa.array(values)]
                yield pa.RecordBatch.from_arrays(columns, ["path", "ksize", "hash"])


@dataclass
class Written(WriterCommitMessage):
    """The list of a task's archives: a file in the job's folder."""

    listing: str


class SigzipWriter(DataSourceArrowWriter):
    """Rows (dir, name, ksize, hash), dealt by (dir, name) and sorted by these and ksize."""

    def __init__(self, options):
        self.root, self.report = options["path"], options.get("report")
        store, at = opened(self.root)
        self.staging = posixpath.join(at, f"_staging-{uuid.uuid4().hex}")
        self.mark = f"{self.staging}/open"
        # the job's folder is made here, on the driver, and never by a task: one that outlives an abort can't bring it back
        store.create_dir(self.staging, recursive=True)
        with store.open_output_stream(self.mark) as out:
            out.write(b"")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, writer = [], None
        store = opened(self.root)[0]

        def ended():
            writer.close()
            done.append({"part": writer.part, "path": writer.path, "n_hashes": writer.n})

        for batch in iterator:
            folder, name, ksize, h = (batch.column(batch.schema.get_field_index(c)) for c in ("dir", "name", "ksize", "hash"))
            for d, n, k, v in zip(folder.to_pylist(), name.to_pylist(), ksize.to_pylist(), h.to_numpy().view(np.uint64).tolist(), strict=True):
                if writer is None or writer.key != (d, n):
                    if writer is not None:
                        ended()
                    if store.get_file_info(self.mark).type == fs.FileType.NotFound:
                        raise RuntimeError("the job was aborted")
                    writer = ArchiveWriter(self.root, d, n, self.staging)
                    writer.begin()
                writer.add(k, v)
        if writer is not None:
            ended()
        listing = f"{self.staging}/{uuid.uuid4().hex}.list"
        with store.open_output_stream(listing) as out:
            out.write("".join(json.dumps(x) + "\n" for x in done).encode())
        return Written(listing)

    def _listed(self, messages) -> list[dict]:
        store, found = opened(self.root)[0], []
        for m in messages:
            if m is not None:
                with store.open_input_stream(m.listing) as f:
                    found += [json.loads(line) for line in io.BytesIO(f.read())]
        return found

    def commit(self, messages) -> None:
        store, found = opened(self.root)[0], self._listed(messages)
        for folder in sorted({posixpath.dirname(x["path"]) for x in found}):
            store.create_dir(folder, recursive=True)
        for x in found:
            store.move(x["part"], x["path"])
        if self.report:
            there, at = opened(self.report)
            there.create_dir(at, recursive=True)
            with there.open_output_stream(f"{at}/written.json") as out:
                out.write("".join(json.dumps({"path": x["path"], "n_hashes": x["n_hashes"]}) + "\n" for x in found).encode())
        self._clear(store)

    def abort(self, messages) -> None:
        self._clear(opened(self.root)[0])

    def _clear(self, store) -> None:
        if store.get_file_info(self.staging).type != fs.FileType.NotFound:
            store.delete_dir(self.staging)


class SigzipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, ksize int, hash long"

    def reader(self, schema) -> SigzipReader:
        return SigzipReader(self.options)

    def writer(self, schema, overwrite: bool) -> SigzipWriter:
        if overwrite:
            raise ValueError("archives are added or replaced one by one: mode 'append'")
        return SigzipWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, with conditions pushed into the reader."""
    spark.dataSource.register(SigzipSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def stream_archives(spark: SparkSession, root: str, mod: int = 521, mode: str = "permissive", **options) -> DataFrame:
    """Occurrences (sample_id, ksize, hash, bucket) of all archives under root, as ``archives.read_archives`` gives them, of archives of any size."""
    register(spark)
    rows = spark.read.format(FORMAT).option("mode", mode).options(**options).load(root)
    flat = rows.select(names.sample_id(F.col("path")).alias("sample_id"), F.col("ksize").cast("smallint").alias("ksize"), "hash")
    return flat.withColumn("bucket", uint64.mod(F.col("hash"), mod))
