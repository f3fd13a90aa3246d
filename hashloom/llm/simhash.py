"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, of two segments. If two fingerprints differ in two bits at most, either the first
segments differ in one bit at most, or the second ones are equal. So a table holds every fingerprint under
(segment number, segment value); each fingerprint looks up the values in the Hamming ball of radius one about its
first segment and its second segment as it is, and the complete distance of each match is verified.

Fingerprints are taken once each, however many rows have them. A table entry (a segment value) of more than ``MOST``
fingerprints isn't fetched pair by pair. All fingerprints that hold or look up such a value enumerate the ball of radius one over both
segments instead, 65 points: two that differ in two bits at most have a point in common, and all that have a
point in common differ in two bits at most, so a star at each point (65 fingerprints at most) says all links. No link is lost, and
the work is in proportion to the fingerprints in either way.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, load, text_views
from .components import connected_components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Seed of XXH64.
SEED = 42
#: Bits that may differ.
DISTANCE = 2
#: Fingerprints with one segment value up to which they are fetched pair by pair.
MOST = 64
#: Bytes of a text whose words are in memory at once.
BLOCK = 1 << 20


def shingle_hashes(text: bytes, words: int = 3, block: int = BLOCK) -> Iterator[np.ndarray]:
    """Arrays of the hashes of a text's word shingles, repeats included; a text with fewer words is one shingle, one without words none."""
    digest, tail, at, none = xxhash.xxh64_intdigest, [], 0, True
    while at < len(text):
        end = at + block
        found = SPACE.search(text, end) if end < len(text) else None
        end = found.start() if found else len(text)
        have = tail + text[at:end].translate(LOWER).split()
        if len(have) >= words:
            joined = b" ".join(have)
            ends = list(itertools.accumulate(len(w) + 1 for w in have))
            spans = zip([0, *ends], ends[words - 1 :], strict=False)
            yield np.fromiter((digest(joined[s : e - 1], SEED) for s, e in spans), np.uint64, len(have) - words + 1)
            none = False
            have = have[len(have) - words + 1 :]
        tail, at = have, end
    if none and tail:
        yield np.array([digest(b" ".join(tail), SEED)], np.uint64)


def fingerprint(text: bytes, words: int = 3) -> int:
    """The bits that are set in over half of the hashes."""
    counts, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, words):
        for part in np.array_split(h, -(-len(h) // 65536)):
            counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(_id, fp) of each row; fp is a BIGINT of the fingerprint's bits. A null text counts as empty."""

    def run(batches):
        for batch in batches:
            raw, starts, _ = text_views(batch, "t")
            data = raw.tobytes()
            prints = np.array([fingerprint(data[a:b], words) for a, b in itertools.pairwise(starts.tolist())], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64), pa.int64())], ["_id", "fp"])

    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, fp long")


def links(prints: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b): edges between the distinct BIGINTs ``fp`` that connect all that differ in two bits at most, and no others."""
    scratch = Scratch(prints.sparkSession, "links")
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))

    def entry(segment, value):
        return F.struct(F.lit(segment).alias("s"), value.alias("v"))

    ball = F.transform(F.array(*(F.lit(m) for m in (0, *(1 << j for j in range(32))))), lambda m: entry(0, high.bitwiseXOR(m)))
    table = prints.select("fp", F.inline(F.array(entry(0, high), entry(1, low))))
    probes = prints.select("fp", F.inline(F.array_append(ball, entry(1, low))))
    crowded = scratch.write(table.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("s", "v"), "crowded")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    # sides that grow with the corpus are never broadcast
    held = table.join(crowded.hint("merge"), ["s", "v"], "left_anti").withColumnRenamed("fp", "b")
    fetched = probes.withColumnRenamed("fp", "a").join(held.hint("merge"), ["s", "v"]).where("a < b").select("a", "b").where(close)
    about = prints.join(probes.join(crowded.hint("merge"), ["s", "v"], "left_semi").select("fp").distinct().hint("merge"), "fp", "left_semi")
    points = F.array(*(F.lit(m) for m in (0, *(1 << j for j in range(63)), -(1 << 63))))
    meeting = about.select("fp", F.explode(F.transform(points, lambda m: F.col("fp").bitwiseXOR(m))).alias("point")).groupBy("point").agg(F.array_sort(F.collect_list("fp")).alias("fps"))
    stars = meeting.where(F.size("fps") > 1).select(F.element_at("fps", 1).alias("a"), F.explode(F.slice("fps", F.lit(2), F.size("fps"))).alias("b")).where(close)
    return fetched.unionByName(stars)


def simhash_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, most: int = MOST) -> DataFrame:
    """Per input row: doc_id, fingerprint (16 hex digits), component_id (the smallest id that links of fingerprints reach).

    Null or empty text, and text of blanks: fingerprint zero, linked like any other. Null id: returned, and chosen
    only where a component has no other id. Repeated rows and several texts of one id: each row has its own fingerprint's
    component. Ties: a bit set in exactly half of the hashes is 0. Very long texts: a megabyte of words in memory at
    a time. Empty table: no rows. Extra columns are not read.
    """
    scratch = Scratch(df.sparkSession, "simhash")
    rows = scratch.write(fingerprints(df, id_col, text_col, words), "prints")
    classes = scratch.write(rows.groupBy("fp").agg(F.min("_id").alias("least")), "classes")
    edges = scratch.write(links(classes.select("fp"), most), "edges")
    labels = connected_components(edges, "a", "b")
    scratch.drop("edges")
    rooted = classes.join(labels.hint("merge"), F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    chosen = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(chosen.hint("merge"), "root").select("fp", "component_id")
    found = rows.join(named.hint("merge"), "fp")
    return found.select(F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    return simhash_duplicates(load(spark, sf_dir, "documents"))
