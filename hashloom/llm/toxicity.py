"""Toxicity by cumulative-link (proportional odds) ordinal regression on sparse text features.

A text's features are its distinct words and word beginnings (so that inflected
forms share evidence), with log-damped counts. Grades come
from the labels: 0 for rows labelled clean; rows labelled toxic get 1 to
``grades`` - 1 by equal parts of their lexical evidence, the damped count of
features that the labels mark as toxic. P(grade > j) = sigmoid(w.x - t_j) with weights shared by all ordered
thresholds t_1 < t_2 < ...; the score is the expected grade, the sum of these.

The fit uses at most ``max_train`` labelled rows, those with the smallest hash
of their ids; the model (some hundred weights) goes to the workers with the
code. Every row of the table is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from .common import Scratch, doc_chunks, text_views
from .word_kernels import GRAM_CODES, U, lower_ascii, mix, owner, runs, span_hashes

#: Bytes of words: ASCII letters and digits, and every byte of other characters.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Lengths in bytes of the word beginnings that are features beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Bands of minima, and the minima of a band, by which copies are told.
BANDS, BAND_ROWS = 4, 3
MAX_TRAIN = 6_000


def occurrences(b: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature hash) of every word and word beginning, in lower case; a text's words come in order."""
    b = lower_ascii(b)
    s, e = runs(LETTER[b], starts)
    doc = owner(s, starts)
    docs, hashes = [doc], [span_hashes(b, s, e)]
    for n in BEGINNINGS:
        longer = np.flatnonzero(e - s > n)
        docs.append(doc[longer])
        hashes.append(span_hashes(b, s[longer], s[longer] + n) ^ U(n))
    return np.concatenate(docs), np.concatenate(hashes)


def counted(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count) of the distinct pairs."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]))) if len(h) else np.zeros(0, np.int64)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


@dataclass
class Model:
    """keys: sorted hashes of the features used; weights: theirs; thresholds: ascending."""

    keys: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, n: int, doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(expected grade, P(grade > 0)) of n texts with these occurrences of features."""
        score = np.zeros(n)
        if len(self.keys) and len(h):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            known = np.flatnonzero(self.keys[at] == h)
            doc, at, count = counted(doc[known], at[known])
            score += np.bincount(doc, self.weights[at] * np.log1p(count), n)
        over = 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -500, 500)))
        return over.sum(axis=1), (over[:, 0] if over.shape[1] else np.zeros(n))


def fit(n: int, row: np.ndarray, feature: np.ndarray, count: np.ndarray, toxic: np.ndarray, keys: np.ndarray, toxic_sign: np.ndarray, grades: int = 4, rounds: int = 600, penalty: float = 0.3) -> Model:
    """A model from n rows, given by (row, place of the feature in the sorted keys, count), with toxic 0 or 1 per row.

    toxic_sign: whether a feature speaks for toxic; those make up the evidence that toxic rows are graded by.
    """
    none = Model(np.zeros(0, U), np.zeros(0), np.zeros(0))
    if not len(keys) or not toxic.any() or toxic.all():
        return none
    r, f, v = row, feature, np.log1p(count.astype(float))
    # grades of toxic rows by their evidence; ties fall on one side
    evidence = np.bincount(r, v * toxic_sign[f], n)
    grade = np.zeros(n, int)
    cuts = np.quantile(evidence[toxic > 0], np.arange(1, grades - 1) / (grades - 1))
    grade[toxic > 0] = 1 + np.searchsorted(cuts, evidence[toxic > 0], "left")
    levels, k, at = grades - 1, len(keys), np.arange(n)
    share = np.clip([(grade > j).mean() for j in range(levels)], 1e-4, 1 - 1e-4)
    t0 = -np.log(share / (1 - share))
    params = np.concatenate([np.zeros(k), [t0[0]], np.log(np.maximum(np.diff(t0), 1e-2))])

    def thresholds(p):
        return p[k] + np.concatenate([[0.0], np.cumsum(np.exp(p[k + 1 :]))])

    def loss(p):
        x = np.bincount(r, v * p[f], n)
        over = 1 / (1 + np.exp(-np.clip(x[:, None] - thresholds(p)[None, :], -500, 500)))
        full = np.concatenate([np.ones((n, 1)), over, np.zeros((n, 1))], axis=1)
        like = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        d = full * (1 - full)
        dx = -(d[at, grade] - d[at, grade + 1]) / like / n
        gt = np.zeros(levels)
        np.add.at(gt, np.minimum(grade, levels - 1)[grade < levels], (-d[at, grade + 1] / like / n)[grade < levels])
        np.add.at(gt, (grade - 1)[grade > 0], (d[at, grade] / like / n)[grade > 0])
        g = np.empty_like(p)
        g[:k] = np.bincount(f, v * dx[r], k) + penalty * p[:k] / n
        g[k] = gt.sum()
        g[k + 1 :] = np.exp(p[k + 1 :]) * np.cumsum(gt[::-1])[::-1][1:]
        return -np.log(like).mean() + 0.5 * penalty * (p[:k] ** 2).sum() / n, g

    m, s = np.zeros_like(params), np.zeros_like(params)
    best, kept = np.inf, params
    for i in range(1, rounds + 1):
        value, g = loss(params)
        if value < best:
            best, kept = value, params.copy()
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        params = params - 0.05 * (m / (1 - 0.9**i)) / (np.sqrt(s / (1 - 0.999**i)) + 1e-10)
    return Model(keys, kept[:k], thresholds(kept))


def labelled_rows(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_train: int) -> DataFrame:
    """(id, toxic, bands, features, counts) of at most max_train labelled rows, those with the smallest hash of their ids.

    bands: for each of BANDS, a hash of several minima over hashes of the features; copies of a text share some.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
        .orderBy(F.xxhash64("_id"), "_id").limit(max_train)
    )
    rows = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    # at most max_train ids of 12 bytes; of an id's several texts the least, so rows are as bounded as ids
    labelled = rows.join(F.broadcast(ids), "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            for i, j in doc_chunks(starts, 1 << 18):
                doc, h, count = counted(*occurrences(raw[starts[i] : starts[j]], starts[i : j + 1] - starts[i]))
                at = np.searchsorted(doc, np.arange(j - i + 1))
                some = np.flatnonzero(np.diff(at))
                bands = np.zeros((j - i, BANDS), U)
                for band in range(BANDS if len(some) else 0):
                    for r in range(BAND_ROWS):
                        bands[some, band] = mix(bands[some, band] + np.minimum.reduceat(mix(h ^ GRAM_CODES[band * BAND_ROWS + r]), at[some]))
                offsets = pa.array(at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(i, j - i) for c in batch.columns[:2]),
                        pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).reshape(-1))),
                        pa.ListArray.from_arrays(offsets, pa.array(h.view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
                    ],
                    ["id", "toxic", "bands", "features", "counts"],
                )

    return labelled.mapInArrow(run, "id long, toxic int, bands array<long>, features array<long>, counts array<int>")


def telling_features(rows: DataFrame, min_docs: int, z: float) -> DataFrame:
    """(feature, positive): features of at least min_docs rows whose rate among toxic rows is z standard errors off.

    A row counts as 1 over the rows that it looks a copy of (those that share a band, for the band with most), for the
    words of a text that was copied often and mislabelled once say nothing.
    """
    bands = rows.select("id", F.posexplode("bands").alias("band", "key"))
    alike = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    # whole millionths, so that sums don't depend on their order
    weight = bands.join(alike, ["band", "key"]).groupBy("id").agg((F.lit(1_000_000) / F.max("n")).cast("long").alias("w"))
    weighed = rows.join(weight, "id")
    total = weighed.agg(F.coalesce(F.sum("w"), F.lit(0)).alias("w"), F.coalesce(F.sum(F.col("w") * F.col("toxic")), F.lit(0)).alias("b")).first()
    rate = total["b"] / total["w"] if total["w"] else 0.0
    if not 0 < rate < 1:
        return rows.sparkSession.createDataFrame([], "feature long, positive boolean")
    counts = weighed.select("toxic", "w", F.explode("features").alias("feature")).groupBy("feature").agg((F.sum("w") / 1e6).alias("have"), (F.sum(F.col("w") * F.col("toxic")) / 1e6).alias("bad"))
    off = (F.col("bad") - F.col("have") * rate) / F.sqrt(F.col("have") * (rate * (1 - rate)))
    return counts.where((F.col("have") >= min_docs) & (F.abs(off) >= z)).select("feature", (off > 0).alias("positive"))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN, grades: int = 4, min_docs: int = 4, z: float = 5.0) -> Model:
    """A model from the rows of ``df`` that ``labels`` (doc_id, toxic 0 or 1) covers.

    Features are counted and chosen by Spark; the driver gets the counts of the
    chosen ones in at most ``max_train`` rows.

    Null ids or labels: left out. An id with several labels: toxic if one is; with several
    texts: its least text. Null, empty or wordless texts: rows without features. No row, or rows of one
    label only: a model that gives 0 to all. Ties among hashes of ids: by id. Extra columns are not read.
    """
    scratch = Scratch(df.sparkSession, "toxicity")
    rows = scratch.write(labelled_rows(df, labels, id_col, text_col, max_train), "rows")
    chosen = telling_features(rows, min_docs, z).collect()
    chosen.sort(key=lambda x: np.uint64(x["feature"] & 0xFFFFFFFFFFFFFFFF))
    keys = np.array([x["feature"] for x in chosen], np.int64).view(U)
    wanted = df.sparkSession.createDataFrame([(x["feature"],) for x in chosen], "feature long")
    held = rows.select("id", F.explode(F.arrays_zip("features", "counts")).alias("p")).select("id", F.col("p.features").alias("feature"), F.col("p.counts").alias("n"))
    found = held.join(F.broadcast(wanted), "feature").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("feature", "n"))).alias("f"))
    sample = rows.select("id", "toxic").distinct().join(found, "id", "left").orderBy("id").collect()
    scratch.drop("rows")
    size = [len(x["f"] or ()) for x in sample]
    flat = [p for x in sample for p in x["f"] or ()]
    feature = np.searchsorted(keys, np.array([p["feature"] for p in flat], np.int64).view(U))
    toxic = np.array([float(x["toxic"] > 0) for x in sample])
    return fit(len(sample), np.repeat(np.arange(len(sample)), size), feature, np.array([p["n"] for p in flat], float), toxic, keys, np.array([x["positive"] for x in chosen], bool), grades)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per input row: doc_id, severity (0 to grades - 1), p_toxic (probability of any grade over 0), toxic (p_toxic >= 0.5), and the ``carry`` columns.

    Null, empty or wordless text: the score of no words. Null id: scored, null
    doc_id. Without a usable label every row gets 0. Repeated rows: scored
    alike. Very long texts: counted a text at a time, memory in proportion to its words. Ties at 0.5: toxic.
    Empty table: no rows. Extra columns are not read unless carried.
    """
    chosen = df.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            parts = [model.severity(j - i, *occurrences(raw[starts[i] : starts[j]], starts[i : j + 1] - starts[i])) for i, j in doc_chunks(starts, 1 << 18)]
            severity, p = (np.concatenate([x[k] for x in parts]) if parts else np.zeros(0) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(severity), pa.array(p), pa.array(p >= 0.5), *batch.columns[2:]], names)

    names = ["doc_id", "severity", "p_toxic", "toxic", *carry]
    out = StructType([StructField("doc_id", LongType()), StructField("severity", DoubleType()), StructField("p_toxic", DoubleType()), StructField("toxic", BooleanType()), *(StructField(c, df.schema[c].dataType) for c in carry)])
    return chosen.mapInArrow(run, out)
