"""Sequence files to sketch archives: one task row a file, whose failure is a result and not the end of the job."""

from __future__ import annotations

import gzip
import re
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import digests, names
from ..sources.archives import ArchiveWriter, opened, write_archives
from .sketch import kept_hashes

RESULT = "path string, out_path string, error string, skipped boolean"


def records(lines) -> Iterator[bytes]:
    """Sequences of a FASTA file's lines, upper case, one a record."""
    held: list[bytes] = []
    for line in lines:
        if line.startswith(b">"):
            if held:
                yield b"".join(held)
            held = []
        else:
            held.append(b"".join(line.split()).upper())
    if held:
        yield b"".join(held)


def sketched(path: str, ksizes, scaled: int, rna: bool) -> dict[int, np.ndarray]:
    """Ascending distinct hashes of a file by k size; sequences are read one at a time."""
    store, at = opened(path)
    found: dict[int, list] = {k: [] for k in ksizes}
    with store.open_input_stream(at, compression=None) as raw, gzip.GzipFile(fileobj=raw) if path.lower().endswith(".gz") else raw as plain:
        lines = plain if isinstance(plain, gzip.GzipFile) else iter_lines(plain)
        for sequence in records(lines):
            sequence = sequence.replace(b"U", b"T") if rna else sequence
            for k in ksizes:
                found[k] += kept_hashes(sequence, k, scaled, True)
    return {k: np.unique(np.concatenate(x)) if x else np.zeros(0, np.uint64) for k, x in found.items()}


def iter_lines(stream, size: int = 1 << 20) -> Iterator[bytes]:
    rest = b""
    while block := stream.read(size):
        *lines, rest = (rest + block).split(b"\n")
        yield from lines
    if rest:
        yield rest


def is_whole(path: str) -> bool:
    """Whether a valid zip archive is at path."""
    store, at = opened(path)
    if not store.get_file_info(at).is_file:
        return False
    try:
        with store.open_input_file(at) as f:
            return zipfile.is_zipfile(f)
    except ValueError:  # shorter than an archive's end
        return False


def sketch_to_archives(files: DataFrame, root: str, ksizes=(15, 31, 33), scaled: int = 1000, rna: bool = False, n_shards: int = 4096, kind: str = "md5", force: bool = False) -> DataFrame:
    """(path, out_path, error, skipped) of each of ``files`` (path): its sketches in ``<root>/<shard of its name>/<name>.sig.zip``.

    A valid archive that is there is kept (skipped) unless ``force``; a damaged one is made anew. A file that can't be
    read, or has no sequence, has an error and no archive (empty files aren't listed by Spark's reader at all). Archives are moved into place whole, so a repeated task changes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder, name in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                writer = ArchiveWriter(root, folder, name)
                out, error, skipped = writer.path, None, False
                try:
                    if not force and is_whole(out):
                        skipped = True
                    else:
                        by_k = sketched(path, ksizes, scaled, rna)
                        if not any(map(len, by_k.values())):
                            raise ValueError("no sequence that gives a hash")
                        writer.begin()
                        for k in sorted(by_k):
                            for h in by_k[k].tolist():
                                writer.add(k, h)
                        writer.finish()
                except (OSError, EOFError, zlib.error, ValueError) as e:
                    writer.abandon()
                    out, error = None, f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((path, pa.string()), (out, pa.string()), (error, pa.string()), (skipped, pa.bool_()))], ["path", "out_path", "error", "skipped"])

    base = names.base_name(F.col("path"))
    placed = files.select("path", digests.shard_dir(base, n_shards, kind).alias("dir"), base.alias("name"))
    # a file is long work for one row, so files are dealt over all tasks
    return placed.repartition("path").mapInArrow(run, RESULT)


#: Bytes of a file in one task, and the longest header line that a cut may fall into.
RANGE, HEADER = 8 << 20, 1 << 20
HEAD = re.compile(rb"^>[^\n]*", re.MULTILINE)
BLANKS = re.compile(rb"\s+")


def pieces(store, at: str, start: int, end: int, more: int) -> Iterator[tuple[bytes, int]]:
    """(bases, n) of the records, or parts of one, in the bytes [start, end) of a FASTA file: the first n bases lie there, up to ``more`` that follow in the same record come after them."""
    with store.open_input_file(at) as f:
        size = f.size()
        end = min(end, size)
        # whether start lies in a header: the line it is in began after the last line end before it
        look = max(0, start - HEADER)
        f.seek(look)
        before = f.read(start - look)
        line = before[before.rfind(b"\n") + 1 :]
        f.seek(start)
        text = f.read(end - start)
        if start and before.endswith(b"\n"):
            line = b""
        headed = (look == 0 or b"\n" in before) and line.startswith(b">")
        if headed:
            cut = text.find(b"\n")
            if cut < 0:
                return
            text = text[cut:]
        starts_line = headed or not line
        found = [m for m in HEAD.finditer(text) if m.start() or starts_line]
        spans = zip([0, *(m.end() for m in found)], [*(m.start() for m in found), len(text)], strict=True)
        parts = [BLANKS.sub(b"", text[a:b]).upper() for a, b in spans]
        tail = len(found) and found[-1].end() == len(text)  # a header goes on behind the range: its record isn't this one's
        last = parts.pop()
        yield from ((p, len(p)) for p in parts if p)
        if not last or tail:
            return
        n, at_line = len(last), text.endswith(b"\n")
        while len(last) < n + more:
            block = f.read(max(4 * more, 4096))
            if not block:
                break
            held = HEAD.search(block) if at_line else next((m for m in HEAD.finditer(block) if m.start()), None)
            last += BLANKS.sub(b"", block[: held.start()] if held else block).upper()
            if held:
                break
            at_line = block.endswith(b"\n")
        yield last[: n + more], n


def sketch_ranges(files: DataFrame, ksizes=(15, 31, 33), scaled: int = 1000, rna: bool = False, size: int = RANGE) -> DataFrame:
    """(path, ksize, hash) of plain FASTA ``files`` (path, length), distinct: a file, and a record however long, is the work of one task per ``size`` bytes.

    A k-mer belongs to the range that its first base lies in; a range reads k - 1 bases on. Header lines have a megabyte at most. Packed files can't be
    cut: they are one task each, in ``sketch_to_archives``.
    """
    most = max(ksizes) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                store, at = opened(path)
                found: dict[int, list] = {k: [] for k in ksizes}
                for bases, n in pieces(store, at, start, end, most):
                    bases = bases.replace(b"U", b"T") if rna else bases
                    for k in ksizes:
                        found[k] += kept_hashes(bases[: n + k - 1], k, scaled, True)
                for k, x in found.items():
                    h = np.unique(np.concatenate(x)).view(np.int64) if x else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(h), pa.string()), pa.array(np.full(len(h), k), pa.int32()), pa.array(h)], ["path", "ksize", "hash"])

    starts = F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long"))
    cut = files.where(~F.lower("path").endswith(".gz")).select("path", F.explode(starts).alias("start")).withColumn("end", F.col("start") + size)
    return cut.repartition("path", "start").mapInArrow(run, "path string, ksize int, hash long").distinct()


def sketch_large_to_archives(files: DataFrame, root: str, ksizes=(15, 31, 33), scaled: int = 1000, rna: bool = False, n_shards: int = 4096, kind: str = "md5", size: int = RANGE) -> DataFrame:
    """(path, n_hashes) of the archives of large plain files, cut over tasks; each is the one that ``sketch_to_archives`` makes."""
    base = names.base_name(F.col("path"))
    rows = sketch_ranges(files, ksizes, scaled, rna, size)
    return write_archives(rows.select(digests.shard_dir(base, n_shards, kind).alias("dir"), base.alias("name"), "ksize", "hash"), root)
