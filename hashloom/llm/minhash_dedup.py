"""MinHash near-deduplication: one-permutation hashing, banded buckets, star-shaped candidate edges.

Each text's distinct word shingles are hashed once; the hash range is split
into bins, a bin keeps its smallest hash, and an empty bin copies a full one
found by a hash of (bin, attempt), the same for all texts (optimal
densification). Bands of bins give bucket keys. Texts with equal sets are one
class first. In a bucket every member is linked to the bucket's centre, not
to every other; candidate edges are confirmed on the full sets.

Before that, texts are closed that can have no link: a shingle that no other
text of any bucket has is in no intersection, so the shingles that are left
(``bound``) bound every intersection of a text; closed texts go, and the
counts are taken anew until none closes. Then shingles that at most RARE open
texts have give pairs of their own, each with its count of common rare shingles;
two texts without such a pair have at most the smaller ``core`` (shingles that
more texts have) in common. Both bounds are exact, and keep the many copies of a frequent text that
differ from it, and from one another, too much to be linked, from being compared.

The centre of a bucket is its member in the largest buckets over all bands,
which is the least changed copy of a family. A star can miss a link between
two members neither of which is the centre. So where members
that have not been centres lie in different components and their sizes and
cores allow a link, CENTRES centres a bucket are taken, from the smallest components
first, and compared with the members of other components. What is still open then
is a family of relatives far apart. It is closed by prefixes: shingles are
ordered by the open texts that have them, rarest first; the first shingle that two linked texts
share stands so early in both that what follows it can make up a link. So open texts
of different components meet over such shingles only, and no pair of all is missed. The
places of a shingle are left out by classes of (size, what follows) before any pair is made.
The pairs of a family grow with the texts that share one of its rare shingles, not with the square of the family.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, doc_chunks, release, text_views
from .components import connected_components
from .word_kernels import GRAM_CODES, SPACE, U, gram_hashes, lower_ascii, mix, owner, runs, span_hashes

#: A shingle that so many open texts have at most is rare.
RARE = 8
#: Centres of a bucket in the second round of stars.
CENTRES = 4
SIGNATURE = "doc_id long, _xx long, n_shingles long, d1 long, d2 long, bands array<long>"


def shingle_sets(b: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, bounds): text i has hashes[bounds[i]:bounds[i + 1]]."""
    n = len(starts) - 1
    b = lower_ascii(b)
    s, e = runs(~SPACE[b], starts)
    doc = owner(s, starts)
    h = span_hashes(b, s, e)
    count = np.bincount(doc, minlength=n)
    first = np.zeros(n + 1, np.int64)
    np.cumsum(count, out=first[1:])
    grams = gram_hashes(h, words)
    given = np.maximum(count - words + 1, (count > 0).astype(np.int64))
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(given, out=bounds[1:])
    out = np.empty(int(bounds[-1]), U)
    keep = np.ones(len(out), bool)
    for i in range(n):
        lo, hi, at = bounds[i], bounds[i + 1], first[i]
        if count[i] >= words:
            seg = np.sort(grams[at : at + hi - lo])
            out[lo:hi] = seg
            keep[lo + 1 : hi] = seg[1:] != seg[:-1]
        elif count[i]:
            k = int(count[i])
            out[lo] = mix((h[at : at + k] * GRAM_CODES[32 : 32 + k]).sum(keepdims=True) + U(k))[0]
    kept = np.zeros(len(out) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return out[keep], kept[bounds]


def densified(hashes: np.ndarray, bounds: np.ndarray, bins: int) -> np.ndarray:
    """(texts, bins) one-permutation minima, densified; texts must not be empty."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    cell = doc * bins + (((hashes >> U(32)) * U(bins)) >> U(32)).astype(np.int64)
    top = U(0xFFFFFFFFFFFFFFFF)
    table = np.full(n * bins, top, U)
    np.minimum.at(table, cell, hashes)
    table = table.reshape(n, bins)
    full = table != top
    row, col = np.nonzero(~full)
    attempt = 0
    while len(row):
        attempt += 1
        source = (mix(np.arange(bins, dtype=U) * U(0x9E3779B97F4A7C15) + U(attempt)) % U(bins)).astype(np.int64)[col]
        ok = full[row, source]
        table[row[ok], col[ok]] = table[row[ok], source[ok]]
        row, col = row[~ok], col[~ok]
    return table


def signatures(df: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            for i, j in doc_chunks(starts):
                h, bounds = shingle_sets(raw[starts[i] : starts[j]], starts[i : j + 1] - starts[i], words)
                size = np.diff(bounds)
                some = np.flatnonzero(size)
                d1, d2 = np.zeros(j - i, U), np.zeros(j - i, U)
                keys = np.zeros((0, bands), U)
                if len(some):
                    at = bounds[:-1][some]
                    d1[some] = np.add.reduceat(mix(h), at)
                    d2[some] = np.add.reduceat(mix(h ^ U(0xA0761D6478BD642F)), at)
                    table = densified(h, np.append(at, bounds[-1]), bands * rows).reshape(len(some), bands, rows)
                    keys = mix((table * GRAM_CODES[:rows]).sum(axis=2) + np.arange(1, bands + 1, dtype=U) * GRAM_CODES[40])
                offsets = np.zeros(j - i + 1, np.int32)
                np.cumsum((size > 0) * bands, out=offsets[1:])
                listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(size), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), listed],
                    ["doc_id", "_xx", "n_shingles", "d1", "d2", "bands"],
                )

    return _chosen(df, id_col, text_col).mapInArrow(run, SIGNATURE)


def full_sets(df: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of rows (node, _text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            for i, j in doc_chunks(starts):
                h, bounds = shingle_sets(raw[starts[i] : starts[j]], starts[i : j + 1] - starts[i], words)
                listed = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), listed], ["node", "shingles"])

    return df.mapInArrow(run, "node long, shingles array<long>")


def _chosen(df, id_col, text_col):
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_xx"))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 85, bands: int = 32, rows: int = 5
) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id, kept, text_xxhash64 (Spark's hash of the row's text, null as empty).

    Texts are linked when 100 * |A & B| >= percent * |A | B| over their sets of
    distinct ``words``-word shingles (ASCII lower case; a shorter text's whole
    word sequence is its one shingle). component_id is the smallest doc_id
    reachable over links. With 32 bands of 5 a link at 0.85 fails to meet
    in any bucket with probability 7e-9.

    Null or empty text, or no words: n_shingles 0, linked with nothing. Null
    id: not linked, component_id null, kept. Rows of one id with different texts: each is a
    node of its own, and all that have their component's smallest id are kept.
    Repeated rows: as equal texts. Very long texts: worked whole, memory in proportion to the
    longest. Ties: a pair at exactly ``percent`` is linked. Empty table: no rows. Extra columns are not read.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "minhash")
    signed = scratch.write(signatures(df, id_col, text_col, words, bands, rows), "signatures")
    named = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    same = ["n_shingles", "d1", "d2"]
    # a class of equal sets is a node, under a number that the written table fixes; its text is that of one of its rows
    one = F.min(F.struct("doc_id", "_xx")).alias("_one")
    grouped = named.groupBy(*same).agg(one, F.first("bands").alias("bands")).select(F.monotonically_increasing_id().alias("node"), *same, F.col("_one.doc_id").alias("first"), F.col("_one._xx").alias("_xx"), "bands")
    classes = scratch.write(grouped, "classes")
    members = scratch.write(_shared_buckets(classes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))), "members")
    pool = classes.join(members.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("_id"), "_xx", "node")
    # repeated rows give one text
    chosen = _chosen(df, id_col, text_col).join(pool, ["_id", "_xx"]).groupBy("_id", "_xx").agg(F.first("node").alias("node"), F.first("_text").alias("_text"))
    sets = scratch.write(full_sets(chosen.select("node", "_text"), words), "sets0")
    release(spark)
    sets = _open_sets(sets, scratch, percent)
    cores, rare = _rare_pairs(sets, scratch, percent)
    buckets = _shared_buckets(members.join(cores, "node"))
    weight = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("_in"))
    popular = buckets.join(weight, "key").groupBy("node").agg(F.sum("_in").alias("popular"))
    buckets = scratch.write(buckets.join(popular, "node").withColumn("component", F.col("node")).withColumn("order", -F.col("popular")), "buckets0")
    heads = scratch.write(_heads(buckets, 1), "heads0")
    links = scratch.write(_confirm(sets, _stars(buckets, heads, percent).union(rare).distinct(), percent), "links0")
    component = connected_components(links, "a", "b")
    for turn in (1, 2):
        buckets = scratch.write(_open_buckets(buckets, heads, component, percent), f"buckets{turn}")
        scratch.drop(f"buckets{turn - 1}")
        release(spark)
        if buckets.isEmpty():
            break
        if turn == 1:
            heads = scratch.write(_heads(buckets, CENTRES), "heads1")
            pairs = _stars(buckets, heads, percent)
        else:
            pairs = _prefix_pairs(sets, buckets.select("node", "n", "component").distinct(), scratch, percent)
        links = scratch.write(_confirm(sets, pairs, percent), f"links{turn}")
        component = scratch.write(_joined(component, links), f"component{turn}")
    reached = classes.select(*same, "first", "node").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = reached.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = reached.join(least, "component").select(*same, "component_id")
    alone = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    final = signed.select("doc_id", *same, F.col("_xx").alias("text_xxhash64")).join(of_class, same, "left").withColumn("component_id", alone)
    return final.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_xxhash64")


def _joined(component: DataFrame, links: DataFrame) -> DataFrame:
    """``component`` (node, component) after new links (a, b): only the components that they join are followed."""
    known = component.select(F.col("node").alias("a"), F.col("component").alias("_a"))
    ends = links.join(known, "a", "left").join(known.select(F.col("a").alias("b"), F.col("_a").alias("_b")), "b", "left")
    ends = ends.select("a", "b", F.coalesce("_a", "a").alias("_a"), F.coalesce("_b", "b").alias("_b"))
    # a component's name is its smallest node, so a name is a node too
    moved = connected_components(ends, "_a", "_b").select(F.col("node").alias("_was"), F.col("component").alias("_now"))
    every = component.unionByName(ends.select(F.col("a").alias("node"), F.col("_a").alias("component"))).unionByName(ends.select(F.col("b").alias("node"), F.col("_b").alias("component"))).distinct()
    return every.join(moved, F.col("component") == F.col("_was"), "left").select("node", F.coalesce("_now", "component").alias("component"))


def _shared_buckets(members: DataFrame) -> DataFrame:
    """The rows of buckets with more than one member."""
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("_in")).where(F.col("_in") > 1).select("key")
    return members.join(shared, "key")


def _open_sets(sets: DataFrame, scratch: Scratch, percent: int, rounds: int = 4) -> DataFrame:
    """(node, shingles, bound) of the texts that may have a link; one row a node, as all counts here are a node's.

    bound: how many of a text's shingles another open text has too. Any number of rounds is right; a
    later one closes texts whose partners have been closed.
    """
    for k in range(1, rounds + 1):
        single = sets.select("node", F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("_n"), F.min("node").alias("node")).where("_n = 1")
        alone = single.groupBy("node").agg(F.count(F.lit(1)).alias("_alone"))
        n = F.size("shingles")
        marked = sets.join(alone, "node", "left").withColumn("bound", n - F.coalesce("_alone", F.lit(0))).drop("_alone")
        left = scratch.write(marked.where(100 * F.col("bound") >= percent * n).select("node", "shingles", "bound"), f"sets{k}")
        before, after = sets.count(), left.count()
        sets = left
        scratch.drop(f"sets{k - 1}")
        release(sets.sparkSession)
        if before == after:
            break
    return sets


def _may(n, m, common, percent: int):
    """Whether sets of n and m with so many in common at most can be linked."""
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * common >= percent * (n + m))


def _rare_pairs(sets: DataFrame, scratch: Scratch, percent: int) -> tuple[DataFrame, DataFrame]:
    """((node, core), pairs (a, b) that share a shingle of 2 to RARE texts and may be linked).

    A text meets at most RARE - 1 others over one shingle.
    """
    single = sets.select("node", F.explode("shingles").alias("s"))
    few = single.groupBy("s").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n").between(2, RARE)).select("s")
    rows = scratch.write(single.join(few, "s"), "rare")
    held = rows.groupBy("node").agg(F.count(F.lit(1)).alias("_rare"))
    cores = scratch.write(sets.join(held, "node", "left").groupBy("node").agg(F.max(F.size("shingles")).alias("_n"), F.max(F.col("bound") - F.coalesce("_rare", F.lit(0))).alias("core")), "cores")
    both = rows.select("s", F.col("node").alias("a")).join(rows.select("s", F.col("node").alias("b")), "s").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("_shared"))
    left = cores.select(F.col("node").alias("a"), F.col("_n").alias("_na"), F.col("core").alias("_ca"))
    right = cores.select(F.col("node").alias("b"), F.col("_n").alias("_nb"), F.col("core").alias("_cb"))
    known = both.join(left, "a").join(right, "b")
    return cores.drop("_n"), known.where(_may(F.col("_na"), F.col("_nb"), F.least("_ca", "_cb") + F.col("_shared"), percent)).select("a", "b")


def _heads(buckets: DataFrame, centres: int) -> DataFrame:
    """At most ``centres`` members of each bucket, in ``order``; the limit is applied per task before the exchange too."""
    if centres == 1:
        best = F.min(F.struct("order", "node", "n", "core", "component")).alias("c")
        return buckets.groupBy("key").agg(best).select("key", "c.*").drop("order")
    along = Window.partitionBy("key").orderBy("order", "node")
    return buckets.withColumn("_rank", F.row_number().over(along)).where(F.col("_rank") <= centres).select("key", "node", "n", "core", "component")


def _stars(buckets: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b), a < b: the centres of each bucket with all others that sizes, cores and components allow."""
    named = heads.select("key", F.col("node").alias("c"), F.col("n").alias("cn"), F.col("core").alias("ccore"), F.col("component").alias("cc"))
    pairs = buckets.join(named, "key").where(F.col("component") != F.col("cc"))
    near = pairs.where(_may(F.col("n"), F.col("cn"), F.least("core", "ccore"), percent))
    return near.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b")).distinct()


def _open_buckets(buckets: DataFrame, heads: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """The members that have not been centres and may still be linked to such a member of another component, by classes of (n, core) in a bucket."""
    left = buckets.drop("component", "order").join(heads.select("key", "node"), ["key", "node"], "left_anti")
    left = left.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    now = _live(left, percent)
    size = now.groupBy("key", "component").agg(F.count(F.lit(1)).alias("order"))
    return now.join(size, ["key", "component"])


def _live(rows: DataFrame, percent: int) -> DataFrame:
    """The rows (key, n, core, component, ...) whose size and core allow a link to a row of another component under the same key, by classes of (n, core)."""
    kinds = rows.groupBy("key", "n", "core").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    other = kinds.select("key", *(F.col(c).alias(f"_{c}") for c in ("n", "core", "lo", "hi")))
    apart = F.least("lo", "_lo") < F.greatest("hi", "_hi")
    live = kinds.join(other, "key").where(apart & _may(F.col("n"), F.col("_n"), F.least("core", "_core"), percent)).select("key", "n", "core").distinct()
    return rows.join(live, ["key", "n", "core"])


def _prefix_pairs(sets: DataFrame, nodes: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Candidate pairs (a, b), a < b, of ``nodes`` (node, n, component) of different components: every pair of these that can be linked.

    Shingles stand in the order of (nodes that have them, hash). If a pair's first common shingle is at place i of a set of n, they have n - i in
    common at most; this is the core here. A shingle of one node only takes a place but meets nothing.
    """
    held = sets.select("node", "shingles").join(nodes, "node").select("node", "n", "component", F.explode("shingles").alias("key"))
    often = held.groupBy("key").agg(F.count(F.lit(1)).alias("_f")).where("_f > 1")
    listed = held.join(often, "key").groupBy("node", "n", "component").agg(F.array_sort(F.collect_list(F.struct("_f", "key"))).alias("_common"))
    single = F.col("n") - F.size("_common")
    # with places from this one on, what follows is under percent of n
    end = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / F.lit(100)) + 1
    early = listed.withColumn("_single", single).withColumn("_early", F.slice("_common", 1, F.greatest(end - single, F.lit(0)).cast("int")))
    placed = early.select("node", "n", "component", "_single", F.posexplode("_early").alias("_i", "_s"))
    places = scratch.write(placed.select("node", "n", "component", F.col("_s.key").alias("key"), (F.col("n") - F.col("_single") - F.col("_i")).alias("core")), "places")
    live = scratch.write(_live(places, percent), "live")
    left = live.select("key", F.col("node").alias("a"), "n", "core", "component")
    right = live.select("key", F.col("node").alias("b"), F.col("n").alias("_n"), F.col("core").alias("_core"), F.col("component").alias("_component"))
    met = left.join(right.hint("merge"), "key").where((F.col("a") < F.col("b")) & (F.col("component") != F.col("_component")))
    return met.where(_may(F.col("n"), F.col("_n"), F.least("core", "_core"), percent)).select("a", "b").distinct()


def _confirm(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that are links by their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    ok = 100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))
    return joined.where(ok).select("a", "b").distinct()
