"""Suffix-array deduplication of byte strings of ``length`` bytes across documents.

A suffix is sorted only where it can matter. In every window of ``length``
bytes the leading tokens (``lead`` bytes) with the least hash are its anchor,
so equal windows have equal anchors at equal offsets; anchors are about one
byte in sixteen. Steps:

1. Anchors whose leading tokens occur once in the corpus are dropped: 48-bit
   remainders meet in hash buckets, and what occurs again goes back
   to the partition of documents it came from. What a worker has seen twice in a
   block of anchors goes back at once, and one entry of it on to the bucket, so a bucket gets a common
   anchor once a block of half a million anchors. Texts equal to an earlier document's
   are settled by their digest.
2. Suffixes of one partition whose windows hold the same bytes are settled among themselves: those of the
   smallest document stay, so a passage that most documents share goes on once a partition.
   The remaining suffixes (with the bytes to their left) are written, and dealt by
   splitters over their leading tokens, which are sampled from all partitions; a frequent passage covers several ranges.
3. A range is sorted by multikey quicksort, once to the right and once to the
   left of the anchors. Longest common prefixes of neighbours give, for every offset of a
   window around its anchor, the classes of equal windows, and a class's smallest document.
4. Across boundaries: classes whose leading tokens stand on a splitter send
   their smallest document's windows, one per class and range, to be compared by a
   digest of the window.
5. Intervals go back to the documents, which are cut.

A row is known by its id and the hash of its text, so an id may have several texts.
All stages work on packed arrays. A task holds a partition of documents (PART_BYTES of
text, or one longer text), BUCKET_ANCHORS anchors (10 bytes each) or
RANGE_SUFFIXES suffixes (106 bytes each); partitions, buckets and ranges grow in number with the
input. The splitters that go to the workers are MOST_RANGES keys of 58 bytes at most; where more
ranges are needed, each is dealt further by a hash of the leading tokens, so there only suffixes of one passage
that hold up to one MOST_RANGES-th of all share a task.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import Scratch, dealt_by, doc_chunks, parts_for, release, text_views
from .word_kernels import BYTE_CODES, GRAM_CODES, U, mix, powers

POSITION = U((1 << 28) - 1)
LOW48 = U((1 << 48) - 1)
#: Texts longer than this are worked in overlapping segments.
SEGMENT = 1 << 19
CHUNK = 1 << 18
PART_BYTES = 8 << 20
#: Bytes that a task of an exchange is to get; more tasks are made where spark.sql.shuffle.partitions would give it more.
TASK_BYTES = 128 << 20
HELD_ANCHORS = 500_000
BUCKET_ANCHORS = 1 << 20
HELD_SUFFIXES = 200_000
PACKED = 50_000
RANGE_SUFFIXES = 150_000
MOST_RANGES = 1 << 15
#: Keys that the splitters are chosen from; one suffix in SAMPLE_EACH is a candidate.
SAMPLE = 40_000
SAMPLE_EACH = 50

#: Rows for a part of the documents: keys of leading tokens (kind 0), copies (1), intervals (2).
TOLD = "part long, kind long, blob binary"


def spark_xxhash64(values: np.ndarray, seed=42) -> np.ndarray:
    """What Spark's xxhash64 gives for longs (the public XXH64 of eight bytes; seed 42 for the first column, the hash so far for others)."""
    p1, p2, p3, p4, p5 = (U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, n):
        return (x << U(n)) | (x >> U(64 - n))

    h = (np.asarray(seed, np.int64).view(U) + p5 + U(8)) ^ (turned(np.ascontiguousarray(values, np.int64).view(U) * p2, 31) * p1)
    h = turned(h, 27) * p1 + p4
    h = (h ^ (h >> U(33))) * p2
    h = (h ^ (h >> U(29))) * p3
    return (h ^ (h >> U(32))).view(np.int64)


def row_parts(ids: np.ndarray, hashes: np.ndarray, parts: int) -> np.ndarray:
    """pmod(xxhash64(id, hash of the text), parts), as the plans have it."""
    return (spark_xxhash64(hashes, spark_xxhash64(ids)) % parts).astype(np.int64)


def window_anchors(b: np.ndarray, starts: np.ndarray, length: int, lead: int):
    """(anchor, first window, last window, hash of the leading tokens, hash of the bytes of all its windows) of every anchor in texts of b.

    The hash of the leading tokens is mixed anew, for the one that anchors are chosen by is small for them all.
    """
    none = np.zeros(0, np.int64)
    n = len(b)
    if n < length:
        return none, none, none, none.view(U), none.view(U)
    p, inverse = powers(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(BYTE_CODES[b] * p[:-1], out=total[1:])
    g = mix((total[lead:] - total[:-lead]) * inverse[: n - lead + 1])
    least = (g & ~POSITION) | np.arange(len(g), dtype=U)
    width, size = length - lead + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    edge = np.zeros(n + 2, np.int32)
    begin, end = starts[:-1], np.maximum(starts[1:] - length + 1, starts[:-1])
    np.add.at(edge, begin, 1)
    np.subtract.at(edge, end, 1)
    valid = np.flatnonzero(np.cumsum(edge[: len(least)]) > 0)
    if not len(valid):
        return none, none, none, none.view(U), none.view(U)
    at = (least[valid] & POSITION).astype(np.int64)
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(first[1:], len(at)) - 1
    anchor, begin, end = at[first], valid[first], valid[last]
    held = mix((total[end + length] - total[begin]) * inverse[begin] + (end - begin).astype(U))
    return anchor, begin, end, mix(g[anchor] ^ GRAM_CODES[5]), held


def segments(raw: np.ndarray, starts: np.ndarray, length: int):
    """(bytes, starts in them, text of each, offset in the text of each) over all texts, about a megabyte at a time."""
    for i, j in doc_chunks(starts, CHUNK):
        lo, hi = int(starts[i]), int(starts[j])
        if hi - lo <= SEGMENT:
            yield raw[lo:hi], starts[i : j + 1] - lo, np.arange(i, j), np.zeros(j - i, np.int64)
            continue
        for at in range(lo, hi, SEGMENT):
            end = min(hi, at + SEGMENT + length - 1)
            yield raw[at:end], np.array([0, end - at]), np.array([i]), np.array([at - lo])
            if end == hi:
                break


def bucket_of(g: np.ndarray, buckets: int) -> np.ndarray:
    return (((g >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of the byte strings in rows (n, m), by multikey quicksort on eight bytes at a time: ties alone go on to the next."""
    n, m = rows.shape
    padded = np.zeros((n, -(-m // 8) * 8), np.uint8)
    padded[:, :m] = rows
    words = padded.view(">u8").astype(U)
    order = np.argsort(words[:, 0], kind="stable")
    group = np.cumsum(np.append(False, words[order[1:], 0] != words[order[:-1], 0])) if n else order
    for k in range(1, words.shape[1]):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        keys = words[order[tied], k]
        inner = np.lexsort((keys, group[tied]))
        order[tied] = order[tied[inner]]
        keys = keys[inner]
        new = np.zeros(n, bool)
        new[1:] = group[1:] != group[:-1]
        held = group[tied]
        new[tied[1:][(keys[1:] != keys[:-1]) & (held[1:] == held[:-1])]] = True
        group = np.cumsum(new)
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Longest common prefix of each sorted row with the one before; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 20_000):
        b = rows[order[at : at + 20_000]]
        differ = rows[order[at - 1 : at - 1 + len(b)]] != b
        out[at : at + len(b)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def window_digests(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row of bytes."""
    p, _ = powers(windows.shape[1])
    out = np.empty((2, len(windows)), U)
    for at in range(0, len(windows), 10_000):
        codes = BYTE_CODES[windows[at : at + 10_000]]
        out[0, at : at + 10_000] = mix((codes * p).sum(axis=1))
        out[1, at : at + 10_000] = mix((mix(codes) * (p * GRAM_CODES[3] + U(1))).sum(axis=1))
    return out[0], out[1]


class Suffixes:
    """Packed suffix records, column by column: document, hash of its text, anchor position, offsets of its windows, bytes around it. In the order of their bytes they compress well."""

    def __init__(self, left: int, right: int):
        self.left, self.right, self.width = left, right, left + right
        self.record = 26 + self.width

    def keys(self, doc, around) -> np.ndarray:
        """What suffixes are ordered by: the bytes from the anchor on, then a number of the document, which splits a frequent passage."""
        out = np.empty((len(doc), self.right + 8), np.uint8)
        out[:, : self.right] = around[:, self.left :]
        out[:, self.right :] = mix(doc.view(U)).astype(">u8").view(np.uint8).reshape(-1, 8)
        return out.view(f"S{self.right + 8}").reshape(-1)

    def pack(self, doc, row, pos, near, far, around) -> bytes:
        plain = b"".join((*(x.astype("<i8").tobytes() for x in (doc, row, pos)), near.astype(np.uint8).tobytes(), far.astype(np.uint8).tobytes(), around.tobytes()))
        return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)

    def unpack(self, blobs):
        parts = [], [], [], [], [], []
        for packed in blobs:
            blob = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)
            n = len(blob) // self.record
            for k, (kind, at) in enumerate((("<i8", 0), ("<i8", 8 * n), ("<i8", 16 * n), (np.uint8, 24 * n), (np.uint8, 25 * n))):
                parts[k].append(np.frombuffer(blob, kind, n, at))
            parts[5].append(np.frombuffer(blob, np.uint8, n * self.width, 26 * n).reshape(n, self.width))
        return [np.concatenate(x) for x in parts]


def repeated_windows(doc, row, pos, near, far, around, length: int, left: int, straddles):
    """Intervals (doc, row, begin, end) to remove, and unresolved windows (h1, h2, doc, row, begin) of straddling classes.

    near and far: the least and largest distance from a window's start to the anchor.
    """
    n = len(doc)
    right_rows, left_rows = around[:, left:], np.ascontiguousarray(around[:, :left][:, ::-1])
    ranks = []
    for rows in (right_rows, left_rows):
        order = multikey_order(rows)
        ranks.append((order, common_prefixes(rows, order)))
    lowest, highest = np.full(n, 255, np.int64), np.full(n, -1, np.int64)
    open_rows = []

    def classes(which, depth):
        order, lcp = ranks[which]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(lcp < depth) if depth else 0
        return out

    for a in range(left + 1):
        chosen = np.flatnonzero((near <= a) & (a <= far))
        if not len(chosen):
            continue
        key = classes(0, length - a)[chosen] * (n + 1) + classes(1, a)[chosen]
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        owner = doc[chosen[order]]
        least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, len(key))))
        again = owner > least
        hit = chosen[order[again]]
        lowest[hit] = np.minimum(lowest[hit], a)
        highest[hit] = a
        rest = chosen[order[~again]]
        rest = rest[straddles[rest]]
        if len(rest):
            h1, h2 = window_digests(around[rest, left - a : left - a + length])
            open_rows.append((h1, h2, doc[rest], row[rest], pos[rest] - a))
    hit = np.flatnonzero(highest >= 0)
    intervals = doc[hit], row[hit], pos[hit] - highest[hit], pos[hit] - lowest[hit] + length
    if open_rows:
        return intervals, [np.concatenate(x) for x in zip(*open_rows, strict=True)]
    return intervals, [np.zeros(0, U), np.zeros(0, U), *(np.zeros(0, np.int64) for _ in range(3))]


def settled(held, length: int, left: int):
    """(which suffixes stay, intervals (doc, row, begin, end)) of suffixes (doc, row, pos, near, far, around, hash of their windows' bytes).

    Of those with the same bytes in the same windows, the ones of the smallest document stay; the others' windows all stand in it.
    """
    doc, row, pos, near, far, around, h = held
    order = np.lexsort((doc, far, near, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order[1:]] != h[order[:-1]]) | (near[order[1:]] != near[order[:-1]]) | (far[order[1:]] != far[order[:-1]])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.flatnonzero(doc[order] > doc[first])
    gone = np.zeros(len(order), bool)
    column = np.arange(around.shape[1]) - left
    for at in range(0, len(later), 20_000):
        i, j = order[later[at : at + 20_000]], first[later[at : at + 20_000]]
        # equal hashes are compared byte by byte, within the windows
        outside = (column < -far[i, None]) | (column >= length - near[i, None])
        gone[i] = ((around[i] == around[j]) | outside).all(axis=1)
    hit = np.flatnonzero(gone)
    return ~gone, (doc[hit], row[hit], pos[hit] - far[hit], pos[hit] - near[hit] + length)


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal runs."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
    return begin[first], end[np.append(first[1:], len(end)) - 1]


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, lead: int = 20, whole_characters: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Per input row: doc_id, n_bytes, spans (flat begin, end of the removed runs), kept (the remaining bytes), and the ``carry`` columns.

    A byte goes if a ``length``-byte string over it also starts in a document
    with a smaller id; strings are those of the input. With
    ``whole_characters`` a run is narrowed to whole UTF-8 characters.

    Null or short text: nothing removed; null counts as empty. Null id: never
    removed from, and no source. Rows of one id with different texts: each is cut by itself, for
    what smaller ids hold; they don't remove from one another. Repeated rows likewise. Very long texts:
    worked in segments, but a text is in one task. Empty table: no rows.
    Extra columns are not read unless carried.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "suffix")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_xx"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    parts = parts_for(size, PART_BYTES)
    buckets = parts_for(size * 2 // (length - lead + 2), BUCKET_ANCHORS)
    dealt = docs.withColumn("part", F.pmod(F.xxhash64("_id", "_xx"), F.lit(parts)))

    # texts equal to an earlier document's: only their ids and digests move
    whole = docs.where(F.col("_id").isNotNull() & (F.octet_length("_text") >= length)).select("_id", "_xx", F.unhex(F.sha2("_text", 256)).alias("_sha"))
    firsts = whole.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    later = whole.join(firsts, "_sha").where(F.col("_id") > F.col("_first")).select("_id", "_xx").distinct()
    copies = scratch.write(later.mapInArrow(_copy_rows(parts), TOLD), "copies")

    # 1. leading tokens that occur again
    found = docs.where("_id IS NOT NULL").select("_id", "_xx", "_text").mapInArrow(_anchor_rows(length, lead, parts, buckets), "bucket long, blob binary")
    tasks = parts_for(size, TASK_BYTES)
    again = dealt_by(found, tasks, "bucket").groupBy("bucket").applyInArrow(_shared_rows(parts), TOLD)
    told = scratch.write(again, "shared").unionByName(copies)
    release(spark)

    # 2. suffixes, and splitters sampled from them
    kind = Suffixes(length - lead, length)
    texts = dealt.where("_id IS NOT NULL").select("_id", "_xx", "_text", "part")
    made = dealt_by(texts, tasks, "part").groupBy("part").cogroup(dealt_by(told, tasks, "part").groupBy("part")).applyInArrow(_suffix_rows(length, lead, buckets, kind), f"{TOLD}, n long, keys binary")
    suffixes = scratch.write(made, "suffixes")
    scratch.drop("shared")
    release(spark)
    records = suffixes.where("kind = 0")
    total = records.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    chosen = records.select("keys").mapInArrow(_sample_rows(min(1.0, SAMPLE * SAMPLE_EACH / max(total, 1)), length + 8), "keys binary")
    keys = [np.frombuffer(bytes(r["keys"]), f"S{length + 8}") for r in chosen.toLocalIterator()]
    keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, f"S{length + 8}")
    ranges = min(MOST_RANGES, parts_for(total, RANGE_SUFFIXES))
    deeper = parts_for(total, RANGE_SUFFIXES * ranges)
    splitters = keys[(np.arange(1, ranges) * len(keys)) // ranges] if len(keys) else keys

    # 3. sort the ranges
    by_range = records.select("blob").mapInArrow(_range_records(lead, kind, splitters, deeper), "range long, blob binary")
    sorted_rows = scratch.write(dealt_by(by_range, parts_for(total * kind.record, TASK_BYTES), "range").groupBy("range").applyInArrow(_range_rows(length, lead, parts, kind, splitters), f"{TOLD}, h1 long, h2 long, doc long, row long, begin long"), "sorted")
    release(spark)

    # 4. across boundaries
    edges = sorted_rows.where("kind = 3").select("h1", "h2", "doc", "row", "begin")
    least = edges.groupBy("h1", "h2").agg(F.min("doc").alias("_least"), F.max("doc").alias("_most")).where("_least < _most")
    across = edges.join(least, ["h1", "h2"]).where("doc > _least").select("doc", "row", "begin").mapInArrow(_across_rows(length, parts), TOLD)
    told = sorted_rows.where("kind = 2").select("part", "kind", "blob").unionByName(suffixes.where("kind = 2").select("part", "kind", "blob")).unionByName(across).unionByName(copies)

    # 5. cut the documents
    fields = [StructField("doc_id", LongType()), StructField("n_bytes", LongType())]
    out = StructType([*fields, *StructType.fromDDL("spans array<long>").fields, StructField("kept", BinaryType()), *(StructField(c, df.schema[c].dataType) for c in carry)])
    return dealt_by(dealt, tasks, "part").groupBy("part").cogroup(dealt_by(told, tasks, "part").groupBy("part")).applyInArrow(_cut_rows(length, whole_characters, carry), out)


def _row_keys(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """(id, hash of the text) as 16 bytes, to be sorted and found as one."""
    return np.ascontiguousarray(np.stack((ids, hashes), axis=1), np.dtype(">i8")).view("S16").reshape(-1)


def _copy_rows(parts):
    def run(batches):
        for batch in batches:
            ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            part = row_parts(ids, hashes, parts)
            order = np.argsort(part, kind="stable")
            yield from _by_key(part[order], [np.stack((ids, hashes), axis=1)[order].astype("<i8")], 1)

    return run


def _by_key(key, columns, kind):
    """One batch of rows (part, kind, blob) of the columns' bytes, by runs of the sorted key."""
    if not len(key):
        return
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    last = np.append(first[1:], len(key))
    blobs = [b"".join(np.ascontiguousarray(c[i:j]).tobytes() for c in columns) for i, j in zip(first, last, strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(key[first].astype(np.int64)), pa.array(np.full(len(first), kind)), pa.array(blobs, pa.binary())], ["part", "kind", "blob"])


def _anchor_rows(length, lead, parts, buckets):
    """Rows (bucket, blob): the low 48 bits of the leading tokens' hashes, as 32 and 16, then the documents' partitions.

    For what a block holds twice: rows (-1 - partition, blob) of whole keys, and one entry under the partition NOBODY.
    """
    kind, nobody = _part_kind(parts)

    def cut(key, blobs):
        if not len(key):
            return key, []
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        last = np.append(first[1:], len(key))
        return key[first], [b"".join(x[i:j].tobytes() for x in blobs) for i, j in zip(first, last, strict=True)]

    def emit(hashes, docs):
        g, part = np.concatenate(hashes), np.concatenate(docs)
        order = np.argsort(g, kind="stable")
        g, part = g[order], part[order]
        new = np.append(True, g[1:] != g[:-1])
        twice = ~new | ~np.append(new[1:], True)
        there, key = part[twice], _key(g[twice], buckets)
        order = np.lexsort((key, there))
        there, key = there[order], key[order]
        fresh = np.append(True, (there[1:] != there[:-1]) | (key[1:] != key[:-1]))[: len(key)]
        known, told = cut(-1 - there[fresh], [key[fresh].astype("<u8")])
        g, part = g[new], np.where(twice, nobody, part)[new]
        low, high = (g & U(0xFFFFFFFF)).astype("<u4"), ((g >> U(32)) & U(0xFFFF)).astype("<u2")
        onward, blobs = cut(bucket_of(g, buckets), [low, high, part.astype(kind)])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate((known, onward))), pa.array(told + blobs, pa.binary())], ["bucket", "blob"])

    def run(batches):
        hashes, docs, held = [], [], 0
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            part = row_parts(*(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)), parts)
            for b, s, text, _ in segments(raw, starts, length):
                anchor, _, _, g, _ = window_anchors(b, s, length, lead)
                if len(anchor):
                    hashes.append(g)
                    docs.append(part[text[np.searchsorted(s[:-1], anchor, "right") - 1]])
                    held += len(g)
                if held > HELD_ANCHORS:
                    yield emit(hashes, docs)
                    hashes, docs, held = [], [], 0
        if held:
            yield emit(hashes, docs)

    return run


def _part_kind(parts):
    """(type of a partition's number in blobs, the number that stands for none)."""
    return (np.dtype("<u2"), 0xFFFF) if parts < 0xFFFF else (np.dtype("<u4"), 0xFFFFFFFF)


def _key(g, buckets):
    """What a hash of leading tokens is known by: its low 48 bits, and 16 of its bucket's number."""
    return (bucket_of(g, buckets).astype(U) << U(48)) | (g & LOW48)


def _shared_rows(parts):
    """The keys of a bucket that occur again, by partition."""
    kind, nobody = _part_kind(parts)
    each = 6 + kind.itemsize

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            key = np.unique(np.concatenate([np.frombuffer(blob.as_buffer(), "<u8") for blob in table.column("blob")]))
            return _table(list(_by_key(np.full(len(key), -1 - bucket), [key], 0)))
        keys, docs = [], []
        for blob in table.column("blob"):
            view = blob.as_buffer()
            n = view.size // each
            low, high = np.frombuffer(view, "<u4", n), np.frombuffer(view, "<u2", n, 4 * n)
            keys.append((high.astype(U) << U(32)) | low)
            docs.append(np.frombuffer(view, kind, n, 6 * n))
        key, part = np.concatenate(keys), np.concatenate(docs).astype(np.int64)
        order = np.argsort(key)
        key, part = key[order], part[order]
        same = key[1:] == key[:-1]
        shared = (np.append(same, False) | np.append(False, same)) & (part != nobody)
        key, part = key[shared] | (U(bucket & 0xFFFF) << U(48)), part[shared]
        order = np.lexsort((key, part))
        key, part = key[order], part[order]
        new = np.append(True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])) if len(key) else np.zeros(0, bool)
        return _table(list(_by_key(part[new], [key[new]], 0)))

    return run


def _table(batches):
    schema = pa.schema([("part", pa.int64()), ("kind", pa.int64()), ("blob", pa.binary())])
    return pa.Table.from_batches(batches, schema)


def _blobs(table: pa.Table, kind: int, dtype) -> np.ndarray:
    chosen = [np.frombuffer(b.as_buffer(), dtype) for k, b in zip(table.column("kind").to_pylist(), table.column("blob"), strict=True) if k == kind]
    return np.concatenate(chosen) if chosen else np.zeros(0, dtype)


def _suffix_rows(length, lead, buckets, kind: Suffixes):
    """Of a part: its suffix records (kind 0) with their number and a sample of their keys, and the intervals settled within it (kind 2)."""
    left = length - lead

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        shared, copies = np.sort(_blobs(told, 0, "<u8")), _row_keys(*_blobs(told, 1, "<i8").reshape(-1, 2).T)
        rows = []

        def emit(held):
            held = [np.concatenate(x) for x in zip(*held, strict=True)]
            stay, intervals = settled(held, length, left)
            if len(intervals[0]):
                rows.append((part, 2, np.stack(intervals, axis=1).astype("<i8").tobytes(), 0, b""))
            doc, row, pos, near, far, around = (x[stay] for x in held[:6])
            keys = kind.keys(doc, around)
            order = np.argsort(keys)
            for at in range(0, len(order), PACKED):
                x = order[at : at + PACKED]
                rows.append((part, 0, kind.pack(doc[x], row[x], pos[x], near[x], far[x], around[x]), len(x), keys[x][part % SAMPLE_EACH :: SAMPLE_EACH].tobytes()))

        held, n = [], 0
        part = texts.column("part")[0].as_py() if len(texts) else -1
        for batch in texts.select(["_id", "_xx", "_text"]).to_batches() if len(shared) else ():
            ids, hashes = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            usable = ~np.isin(_row_keys(ids, hashes), copies)
            raw, starts, _ = text_views(batch, "_text")
            for b, s, text, base in segments(raw, starts, length):
                anchor, first, last, g, same = window_anchors(b, s, length, lead)
                if not len(anchor):
                    continue
                key = _key(g, buckets)
                at = np.minimum(np.searchsorted(shared, key), len(shared) - 1)
                which = np.searchsorted(s[:-1], anchor, "right") - 1
                good = (shared[at] == key) & usable[text[which]]
                anchor, first, last, which, same = (x[good] for x in (anchor, first, last, which, same))
                if not len(anchor):
                    continue
                padded = np.zeros(len(b) + left + length, np.uint8)
                padded[left : left + len(b)] = b
                around = np.lib.stride_tricks.sliding_window_view(padded, left + length)[anchor]
                own = text[which]
                held.append((ids[own], hashes[own], anchor - s[which] + base[which], anchor - last, anchor - first, around, same))
                n += len(anchor)
                if n > HELD_SUFFIXES:
                    emit(held)
                    held, n = [], 0
        if held:
            emit(held)
        schema = pa.schema([("part", pa.int64()), ("kind", pa.int64()), ("blob", pa.binary()), ("n", pa.int64()), ("keys", pa.binary())])
        return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    return run


def _sample_rows(share, width):
    """Each key with this probability."""

    def run(batches):
        for batch in batches:
            for blob in batch.column(0):
                n = len(blob.as_buffer()) // width if blob.is_valid else 0
                keys = np.frombuffer(blob.as_buffer(), f"S{width}", n)
                seed = zlib.crc32(blob.as_buffer())
                kept = keys[np.random.Generator(np.random.PCG64(seed)).random(n) < share]
                if len(kept):
                    yield pa.RecordBatch.from_arrays([pa.array([kept.tobytes()], pa.binary())], ["keys"])

    return run


def _range_records(lead, kind: Suffixes, splitters, deeper):
    """Suffix records by range; a range is dealt further by a hash of the leading tokens where ``deeper`` is over 1."""

    def emit(held):
        doc, row, pos, near, far, around = (np.concatenate(x) for x in zip(*held, strict=True))
        keys = kind.keys(doc, around)
        order = np.argsort(keys)
        to = np.searchsorted(splitters, keys[order], "right").astype(np.int64)
        if deeper > 1:
            h = window_digests(around[order, kind.left : kind.left + lead])[0]
            to = to * deeper + (h % U(deeper)).astype(np.int64)
            again = np.argsort(to, kind="stable")
            order, to = order[again], to[again]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        blobs = []
        for i, j in zip(first, np.append(first[1:], len(to)), strict=True):
            x = order[i:j]
            blobs.append(kind.pack(doc[x], row[x], pos[x], near[x], far[x], around[x]))
        return pa.RecordBatch.from_arrays([pa.array(to[first]), pa.array(blobs, pa.binary())], ["range", "blob"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for blob in batch.column(0):
                held.append(kind.unpack([blob.as_py()]))
                n += len(held[-1][0])
                if n > HELD_SUFFIXES:
                    yield emit(held)
                    held, n = [], 0
        if held:
            yield emit(held)

    return run


def _range_rows(length, lead, parts, kind: Suffixes, splitters):
    left = length - lead
    leads = np.unique(splitters.astype(f"S{lead}")) if len(splitters) else np.zeros(0, f"S{lead}")

    def run(table: pa.Table) -> pa.Table:
        doc, row, pos, near, far, around = kind.unpack([b.as_py() for b in table.column("blob")])
        heads = np.ascontiguousarray(around[:, left : left + lead]).view(f"S{lead}").reshape(-1)
        straddles = np.isin(heads, leads)
        (d, r, begin, end), open_rows = repeated_windows(doc, row, pos, near.astype(np.int64), far.astype(np.int64), around, length, left, straddles)
        part = row_parts(d, r, parts)
        order = np.argsort(part, kind="stable")
        rows = _table(list(_by_key(part[order], [np.stack((d, r, begin, end), axis=1)[order].astype("<i8")], 2)))
        n, m = len(rows), len(open_rows[0])
        pad = pa.nulls(n, pa.int64())
        resolved = pa.Table.from_arrays([*rows.columns, pad, pad, pad, pad, pad], names=[*rows.schema.names, "h1", "h2", "doc", "row", "begin"])
        edge = pa.Table.from_arrays(
            [pa.nulls(m, pa.int64()), pa.array(np.full(m, 3, np.int64)), pa.nulls(m, pa.binary()), *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in open_rows)],
            names=resolved.schema.names,
        )
        return pa.concat_tables([resolved, edge])

    return run


def _across_rows(length, parts):
    def run(batches):
        for batch in batches:
            doc, row, begin = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2))
            part = row_parts(doc, row, parts)
            order = np.argsort(part, kind="stable")
            yield from _by_key(part[order], [np.stack((doc, row, begin, begin + length), axis=1)[order].astype("<i8")], 2)

    return run


def _cut_rows(length, whole_characters, carry):
    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        copies, cuts = _row_keys(*_blobs(told, 1, "<i8").reshape(-1, 2).T), _blobs(told, 2, "<i8").reshape(-1, 4)
        cut_rows = _row_keys(cuts[:, 0], cuts[:, 1])
        order = np.argsort(cut_rows, kind="stable")
        cuts, cut_rows = cuts[order], cut_rows[order]
        batches, names = [], ["doc_id", "n_bytes", "spans", "kept", *carry]
        for batch in texts.to_batches():
            raw, starts, _ = text_views(batch, "_text")
            ids, data = batch.column(0), raw.tobytes()
            sizes = np.diff(starts)
            spans, kept = [], []
            null = np.asarray(ids.is_null())
            rows = _row_keys(ids.fill_null(0).to_numpy(zero_copy_only=False), batch.column(batch.schema.get_field_index("_xx")).to_numpy(zero_copy_only=False))
            lo, hi = np.searchsorted(cut_rows, rows, "left"), np.searchsorted(cut_rows, rows, "right")
            copied = np.isin(rows, copies) & (sizes >= length) & ~null
            for i in range(len(rows)):
                at, n = int(starts[i]), int(sizes[i])
                text = data[at : at + n]
                if copied[i]:
                    runs = [(0, n)]
                elif null[i] or lo[i] == hi[i]:
                    runs = []
                else:
                    x = cuts[lo[i] : hi[i]]
                    runs = [(int(a), int(b)) for a, b in zip(*merged(x[:, 2], x[:, 3]), strict=True)]
                if whole_characters:
                    runs = [r for r in (_narrowed(text, a, b) for a, b in runs) if r[0] < r[1]]
                spans.append([y for r in runs for y in r])
                if runs:
                    ends = [0, *(y for r in runs for y in r), n]
                    text = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                kept.append(text)
            more = [batch.column(batch.schema.get_field_index(f"_c{k}")) for k in range(len(carry))]
            batches.append(pa.RecordBatch.from_arrays([ids, pa.array(sizes), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary()), *more], names))
        if not batches:
            more = [pa.array([], texts.schema.field(f"_c{k}").type) for k in range(len(carry))]
            batches.append(pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64())), pa.array([], pa.binary()), *more], names))
        return pa.Table.from_batches(batches)

    return run


def _narrowed(text: bytes, begin: int, end: int) -> tuple[int, int]:
    while begin < end and text[begin] & 0xC0 == 0x80:
        begin += 1
    while end > begin and end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end
