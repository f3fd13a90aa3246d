"""Quality rules: base limits, then robust multivariate outliers.

Text statistics of whole texts are computed once per document. Within each
(language, source) group a minimum-covariance-determinant estimate is found by concentration steps: the h
rows nearest to the current centre give the next centre and covariance, which never makes the
determinant larger. Several starts (medians and spreads, all rows, and thirds of the rows chosen by a hash) go through
the first steps side by side; the one with the least determinant goes on until its determinant
stays. The estimate is scaled so that the median distance is that of the chi-square distribution, and taken once more
from the rows within that distribution's 97.5 % point (the usual reweighting).

All rows of a group take part in every step; medians and h-quantiles come from counts on a fine grid, so a step
is two aggregations with map-side combining and no group is ever gathered, and
parameters stay in a table joined on the group (Spark broadcasts it only below
its own size threshold). Rows whose squared Mahalanobis distance exceeds the
chi-square quantile of ``tail`` are rejected. Groups below ``min_rows`` use their language's estimate.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, doc_chunks, text_views
from .word_kernels import SPACE, U, gram_hashes, mix, owner, runs, span_hashes

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Transformed statistics, and the least standard deviation that an estimate may have in each.
VECTOR = {"x_word": 0.08, "x_symbol": 0.15, "x_dup": 0.2, "x_repeat": 0.2}
GRID = 1000.0
#: Starts beside medians and all rows: the rows are split by a hash into so many parts.
THIRDS = 3
#: Steps that all starts take, and at most that the best one takes.
FIRST_STEPS, MOST_STEPS = 2, 12


def chi2_quantile(share: float, degrees: int = len(VECTOR)) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom, by bisection of its closed form."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        x = (lo + hi) / 4  # half of the middle
        upper = math.exp(-x) * sum(x**k / math.factorial(k) for k in range(degrees // 2))
        lo, hi = (2 * x, hi) if upper > 1 - share else (lo, 2 * x)
    return lo


def text_statistics(b: np.ndarray, starts: np.ndarray, window: int = 8) -> np.ndarray:
    """STATS of each text; (texts, 6) int64. b: the texts' bytes, starts: where each begins, with the end."""
    n = len(starts) - 1
    out = np.zeros((n, len(STATS)), np.int64)
    if not len(b):
        return out
    inside = ~SPACE[b]

    given = np.flatnonzero(np.diff(starts))

    def per_text(flags):
        out = np.zeros(n, np.int64)
        out[given] = np.add.reduceat(flags.view(np.uint8), starts[given], dtype=np.int64)
        return out

    s, e = runs(inside, starts)
    doc = owner(s, starts)
    out[:, 0] = np.bincount(doc, minlength=n)
    out[:, 1] = per_text(inside & ((b & 0xC0) != 0x80))
    out[:, 2] = per_text(SYMBOL[b])
    ls, le = runs(b != 0x0A, starts)
    worded = np.searchsorted(s, le) > np.searchsorted(s, ls)
    ls, le = ls[worded], le[worded]
    line_doc = owner(ls, starts)
    out[:, 5] = np.bincount(line_doc, minlength=n)
    if len(ls):
        distinct = mix(span_hashes(b, ls, le) + mix(line_doc.astype(U) + U(1)))
        order = np.argsort(distinct, kind="stable")
        again = distinct[order[1:]] == distinct[order[:-1]]
        out[:, 3] = np.bincount(line_doc[order[1:][again]], minlength=n)
    grams = gram_hashes(span_hashes(b, s, e), window)
    if len(grams):
        valid = np.flatnonzero(doc[: len(grams)] == doc[window - 1 :])
        key = mix(grams[valid] + mix(doc[valid].astype(U) + U(1)))
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        cover = np.zeros(len(s) + 1, np.int64)
        cover[valid[twice]] += 1
        np.subtract.at(cover, valid[twice] + window, 1)
        out[:, 4] = np.bincount(doc[np.cumsum(cover[:-1]) > 0], minlength=n)
    return out


def statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols=("lang", "source")) -> DataFrame:
    """doc_id, the group columns as _g0, _g1 (null: empty), and STATS of each row."""
    fields = "doc_id long, _g0 string, _g1 string, " + ", ".join(f"{c} long" for c in STATS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, starts, _ = text_views(batch, "_text")
            found = [text_statistics(raw[starts[i] : starts[j]], starts[i : j + 1] - starts[i]) for i, j in doc_chunks(starts)]
            got = np.concatenate(found) if found else np.zeros((0, len(STATS)), np.int64)
            columns = [batch.column(0), batch.column(1), batch.column(2), *(pa.array(np.ascontiguousarray(got[:, k])) for k in range(len(STATS)))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_g0", "_g1", *STATS])

    chosen = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_g{k}") for k, c in enumerate(group_cols)),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    return chosen.mapInArrow(run, fields)


def vectors(stats: DataFrame) -> DataFrame:
    """The statistics on scales on which clean texts are near normal; shares of short texts are drawn to the usual."""
    words = F.col("n_words")
    return stats.withColumns(
        {
            "x_word": F.log((F.col("word_chars") + 250) / (words + 50)),
            "x_symbol": F.log1p(100 * F.col("n_symbols") / (words + 50)),
            "x_dup": F.log1p(20 * F.col("n_dup_lines") / (F.col("n_lines") + 5)),
            "x_repeat": F.log1p(20 * F.col("n_repeat_words") / (words + 50)),
        }
    )


def _quantiles(rows: DataFrame, value: str, share: float, name: str, by=("_grp",)) -> DataFrame:
    """Per group, the value (on a grid of 1/GRID) below or at which ``share`` of the rows lie."""
    counts = rows.select(*by, F.round(F.col(value) * GRID).cast("long").alias("_bin")).groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    along = Window.partitionBy(*by).orderBy("_bin")
    upto = F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumns({"_upto": upto, "_all": F.sum("_n").over(Window.partitionBy(*by))})
    return ranked.where(F.col("_upto") >= F.ceil(F.col("_all") * share)).groupBy(*by).agg((F.min("_bin") / GRID).alias(name))


def _factored(moments: DataFrame) -> DataFrame:
    """moments (m_i, c_i_j) with the lower Cholesky factor l_i_j of the covariance, and ``log_det``, the logarithm of its determinant.

    A variance is at least the square of VECTOR's floor.
    """
    floors, p = list(VECTOR.values()), len(VECTOR)
    for i in range(p):
        for j in range(i + 1):
            dot = functools.reduce(lambda a, b: a + b, (F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            c = F.greatest(F.col(f"c_{i}_{j}"), F.lit(floors[i] ** 2)) if i == j else F.col(f"c_{i}_{j}")
            entry = F.sqrt(F.greatest(c - dot, F.lit(1e-9))) if i == j else (c - dot) / F.col(f"l_{j}_{j}")
            moments = moments.withColumn(f"l_{i}_{j}", entry)
    return moments.withColumn("log_det", functools.reduce(lambda a, b: a + b, (2 * F.log(f"l_{i}_{i}") for i in range(p))))


def _moments(rows: DataFrame, *by: str) -> DataFrame:
    names = list(VECTOR)
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    return rows.groupBy(*by).agg(*(F.avg(x).alias(f"m_{i}") for i, x in enumerate(names)), *(F.covar_pop(names[i], names[j]).alias(f"c_{i}_{j}") for i, j in pairs))


def _distance(rows: DataFrame, params: DataFrame, *by: str) -> DataFrame:
    """rows with _d2, the squared Mahalanobis distance under their group's parameters; one row for each of a group's starts if ``by`` has them."""
    joined = rows.join(params, "_grp")
    names = list(VECTOR)
    for i, x in enumerate(names):
        part = F.col(x) - F.col(f"m_{i}")
        for k in range(i):
            part = part - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        joined = joined.withColumn(f"y_{i}", part / F.col(f"l_{i}_{i}"))
    total = functools.reduce(lambda a, b: a + b, (F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(len(names))))
    return joined.select(*rows.columns, *by, total.alias("_d2"))


def _concentrated(rows: DataFrame, params: DataFrame, share: float, *by: str) -> DataFrame:
    """One step: the parameters of the ``share`` of each group's rows that are nearest under ``params``; ties at the limit count as inside."""
    key = ["_grp", *by]
    far = _distance(rows, params, *by).withColumn("_log", F.log1p("_d2"))
    limit = _quantiles(far, "_log", share, "_limit", tuple(key))
    kept = far.join(limit, key).where(F.round(F.col("_log") * GRID) <= F.round(F.col("_limit") * GRID))
    return _factored(_moments(kept, *key))


def _starts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Parameters of every start (_grp, _start): 0 medians and spreads, 1 all rows, then those of each third."""
    names = list(VECTOR)
    long = rows.select("_grp", F.explode(F.array(*(F.struct(F.lit(i).alias("k"), F.col(x).alias("v")) for i, x in enumerate(names)))).alias("p")).select("_grp", "p.k", "p.v")
    middle = scratch.write(_quantiles(long, "v", 0.5, "m", ("_grp", "k")), "middle")
    off = long.join(middle, ["_grp", "k"]).select("_grp", "k", F.abs(F.col("v") - F.col("m")).alias("v"))
    spread = _quantiles(off, "v", 0.5, "s", ("_grp", "k"))
    robust = middle.join(spread, ["_grp", "k"]).groupBy("_grp").agg(
        *(F.max(F.when(F.col("k") == i, F.col("m"))).alias(f"m_{i}") for i in range(len(names))),
        *(F.max(F.when(F.col("k") == i, F.pow(F.col("s") * 1.4826, 2)) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i in range(len(names)) for j in range(i + 1)),
    ).withColumn("_start", F.lit(0))
    third = (F.pmod(F.xxhash64("doc_id", *names), F.lit(THIRDS)) + 2).cast("int")
    parted = rows.select("_grp", *names, F.explode(F.array(F.lit(1), third)).alias("_start"))
    return _factored(robust.unionByName(_moments(parted, "_grp", "_start")))


def mcd_estimate(rows: DataFrame, scratch: Scratch, share: float = 0.75) -> DataFrame:
    """Per group (_grp) of rows (_grp, doc_id and VECTOR): centre m_i, Cholesky factor l_i_j, log_det (of the estimate before reweighting), _scale of squared distances."""
    rows = rows.select("_grp", "doc_id", *VECTOR)
    params = scratch.write(_starts(rows, scratch), "starts")
    for step in range(FIRST_STEPS):
        params = scratch.write(_concentrated(rows, params, share, "_start"), f"starts{step}")
    best = F.min_by(F.struct(*(c for c in params.columns if c not in ("_grp", "_start"))), F.struct("log_det", "_start"))
    params = scratch.write(params.groupBy("_grp").agg(best.alias("b")).select("_grp", "b.*"), "best")
    for step in range(MOST_STEPS):
        following = scratch.write(_concentrated(rows, params, share), f"params{step}")
        gain = params.select("_grp", F.col("log_det").alias("_was")).join(following, "_grp").agg(F.max(F.col("_was") - F.col("log_det"))).first()[0]
        if gain is None or gain < 1e-4:
            break
        params = following
    first = _scaled(rows, params)
    near = _distance(rows, first, "_scale").where(F.col("_d2") <= F.col("_scale") * chi2_quantile(0.975))
    again = _factored(_moments(near, "_grp")).drop("log_det").join(params.select("_grp", "log_det"), "_grp")
    return scratch.write(_scaled(rows, scratch.write(again, "reweighted")), "estimate")


def _scaled(rows: DataFrame, params: DataFrame) -> DataFrame:
    """params with _scale: what the median squared distance is to the chi-square median, 1 at least (where the floors hold)."""
    far = _distance(rows, params).withColumn("_log", F.log1p("_d2"))
    middle = _quantiles(far, "_log", 0.5, "_mid")
    return params.join(middle, "_grp").withColumn("_scale", F.greatest(F.expm1("_mid") / chi2_quantile(0.5), F.lit(1.0))).drop("_mid")


def quality_rules(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols=("lang", "source"),
    min_words: int = 20,
    max_repeat_percent: int = 30,
    share: float = 0.75,
    tail: float = 1e-9,
    min_rows: int = 40,
) -> DataFrame:
    """Per input row: doc_id, the statistics, base_failed, distance, kept.

    Rows that fail a base limit are neither kept nor part of an estimate.
    The cutoff on the squared distance is the chi-square quantile of 1 - ``tail``.

    Null or empty text: no words, so base_failed. Null group columns: the group
    of the empty name. Groups under ``min_rows``: the language's estimate (which
    takes all its rows). Ties at a quantile all count as inside. Repeated rows
    count each. Null id: null in the result. Very long texts: worked whole, memory in proportion to the
    longest. Empty table: no rows. Extra columns are not read.
    """
    scratch = Scratch(df.sparkSession, "quality")
    stats = scratch.write(statistics(df, id_col, text_col, group_cols), "stats")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rated = vectors(stats.withColumn("base_failed", failed))
    passed = rated.where(~F.col("base_failed")).select("_g0", "_g1", "doc_id", *VECTOR)
    sizes = scratch.write(passed.groupBy("_g0", "_g1").agg((F.count(F.lit(1)) >= min_rows).alias("_own")), "sizes")
    own, whole = F.concat_ws("\x1f", F.lit("s"), "_g0", "_g1"), F.concat_ws("\x1f", F.lit("l"), "_g0")
    marked = rated.where(~F.col("base_failed")).join(sizes, ["_g0", "_g1"])
    # a language's rows are estimated together only where one of its groups needs it
    needing = sizes.where(~F.col("_own")).select("_g0").distinct()
    fit = marked.where("_own").select(own.alias("_grp"), "doc_id", *VECTOR).unionByName(passed.join(needing, "_g0", "left_semi").select(whole.alias("_grp"), "doc_id", *VECTOR))
    judged = marked.select("doc_id", *STATS, F.when(F.col("_own"), own).otherwise(whole).alias("_grp"), *VECTOR, F.col("_own"))
    estimate = mcd_estimate(scratch.write(fit, "fit"), scratch, share)
    far = _distance(judged, estimate, "_scale").withColumn("_d2", F.col("_d2") / F.col("_scale"))
    good = far.select("doc_id", *STATS, F.lit(False).alias("base_failed"), F.col("_d2").alias("distance"), (F.col("_d2") <= chi2_quantile(1 - tail)).alias("kept"))
    bad = rated.where("base_failed").select("doc_id", *STATS, F.lit(True).alias("base_failed"), F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return good.unionByName(bad)
