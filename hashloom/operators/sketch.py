"""FracMinHash sketching of sequences: k-shingles, canonical form, a 64-bit hash, a scaled threshold.

``md5_60`` is 15 hexadecimal digits of the shingle's MD5, so values are in [0, 2**60);
``murmur3_64`` is the low half of MurmurHash3 x64 128 with seed 42. Both are computed for
Arrow batches, many shingles at a time (``windows``); only hashes under the threshold leave
the function, so one row per position is never made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import md5, uint64, windows
from ..functions.murmur import murmur3_words

MURMUR_SEED = 42
HASHES = {"md5_60": 1 << 60, "murmur3_64": 1 << 64}


def threshold(hash_name: str, scaled: int) -> int:
    """Hashes below it are kept: a share of 1 in ``scaled`` of all values."""
    return HASHES[hash_name] // scaled


def sketch(df: DataFrame, sequence: str, sample: str, ksizes=(31,), scaled: int = 1000, hash_name: str = "md5_60", dna: bool = False, mod: int = 521) -> DataFrame:
    """Occurrences (sample_id, ksize, hash, bucket) of the kept shingles; repeats within a sequence may stay.

    The canonical shingle is the smaller of itself and its reverse (``dna``: its
    reverse complement; shingles with other letters than ACGT are skipped).
    """
    if hash_name not in HASHES:
        raise ValueError(f"hash_name is one of {sorted(HASHES)}")
    named = F.col(sample).cast("string") if hash_name == "murmur3_64" else F.col(sample)
    flat = _kept(df.select(named.alias("sample_id"), F.col(sequence).alias("_s")), "_s", sorted(set(ksizes)), hash_name, scaled, dna)
    return flat.withColumn("bucket", uint64.mod(F.col("hash"), mod))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files give fewer partitions; one row becomes thousands downstream."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _md5_below(chunk: windows.Chunk, k: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(which, hashes) of the k-shingles of a chunk whose hash is under the limit."""
    n = len(chunk.at) - k
    sizes = np.full(1, k) if chunk.plain else chunk.at[k:] - chunk.at[:-k]
    blocks = (sizes + 8) // 64 + 1
    found = []
    for count in range(int(blocks.min()), int(blocks.max()) + 1):
        which = None if chunk.plain else np.flatnonzero(blocks == count)
        if which is not None and not len(which):
            continue
        words = windows.canonical(chunk, k, which, np.uint32, 0x80)
        bits = 8 * k if which is None else (8 * sizes[which]).astype(np.uint32)
        words += [0] * (16 * count - 2 - len(words))
        at, values = md5.below([*words, bits, 0], n if which is None else len(which), limit)
        found.append((at if which is None else which[at], values))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _murmur_below(chunk: windows.Chunk, k: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(which, hashes as signed values of the same bits), as above for MurmurHash3 and shingles of k bytes."""
    h = murmur3_words(windows.canonical(chunk, k, None, np.uint64), k, MURMUR_SEED)[0]
    which = np.flatnonzero(h < np.uint64(min(limit, (1 << 64) - 1)))
    return which, h[which].view(np.int64)


def _kept(df, sequence, ksizes, hash_name, scaled, dna):
    # the texts of a batch are one run of bytes; a shingle over the end of its text is left out once it is known to be under the threshold
    limit, schema = threshold(hash_name, scaled), pa.schema([("ksize", pa.int16()), ("hash", pa.int64())])

    by_bytes = hash_name == "murmur3_64"
    below = _murmur_below if by_bytes else _md5_below

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).cast(pa.large_string())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            ends = ends - ends[0]
            for start, stop, end in windows.cuts(data, 4 * ksizes[-1], by_bytes):
                chunk = windows.Chunk(data[start:end], by_bytes, dna)
                for k in ksizes:
                    if len(chunk.at) <= k:
                        continue
                    which, hashes = below(chunk, k, limit)
                    first, last = chunk.at[which], chunk.at[which + k]
                    row = np.searchsorted(ends, start + first, "right") - 1
                    kept = (start + first < stop) & (start + last <= ends[row + 1]) & chunk.whole(first, last)
                    if kept.any():
                        columns = [pa.array(np.full(int(kept.sum()), k, np.int16)), pa.array(hashes[kept].astype(np.int64, copy=False))]
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(row[kept])), *columns], ["sample_id", *schema.names])

    texts = spread(df.select("sample_id", F.col(sequence).cast("string").alias("_s")).where(F.octet_length("_s") >= ksizes[0]))
    kind = texts.schema["sample_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"sample_id {kind}, ksize smallint, hash long")


def kept_hashes(sequence: bytes, k: int, scaled: int, dna: bool, chunk: int = windows.CHUNK) -> Iterator[np.ndarray]:
    """Distinct MurmurHash3 values under the threshold, a chunk of positions at a time."""
    b, limit = np.frombuffer(sequence, np.uint8), threshold("murmur3_64", scaled)
    for at in range(0, len(b) - k + 1, chunk):
        part = windows.Chunk(b[at : at + chunk + k - 1], True, dna)
        which, hashes = _murmur_below(part, k, limit)
        yield np.unique(hashes[part.whole(which, which + k)].view(np.uint64))
