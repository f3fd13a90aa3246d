"""Line deduplication by winnowing over line hashes (DataFrame operations only).

A text's lines are hashed with their outer blanks off. Of every window of
``run_lines`` lines the line with the least hash (the first of equals) is its
fingerprint, so a run of that length that stands twice has a common
fingerprint, at one offset. There is one row per fingerprint position; it carries the hashes of
the lines around it. Positions whose fingerprint stands nowhere else are dropped.

A position is joined with earlier ones of its fingerprint: not with all, but with the
first of each context, a context being one of its windows. From such a pair the match is
extended line by line to both sides, and what it covers of the later text goes. A match is
followed for ``run_lines - 1`` lines a side: as far as the windows of this
fingerprint reach, and where a longer run has its next one, which goes on from there. So
a longer repeated run goes as a whole, and each pair has a bounded cost.

Where long lines count by themselves, windows of fewer lines are made in the same
way, of what holds enough text and of whole short texts.

Fingerprints and contexts meet in aggregations with map-side combining, and go
back by joins with one row per key on the other side: the rows grow with the
lines, never with the square of a line's count.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

BLANK = " \t\r"
#: What one or two lines must hold to be a run by themselves.
LONG_WORDS, LONG_CHARS = 50, 300


def window_kinds(run_lines: int, short: bool) -> list[tuple[int, int]]:
    """(lines, place of the fingerprint in them) of all windows that may hold a position; its place in the list is its bit."""
    return [(size, back) for size in range(1 if short else run_lines, run_lines + 1) for back in range(size)]


def line_positions(df: DataFrame, id_col: str, text_col: str, run_lines: int, min_chars: int, long_words: int | None = None, long_chars: int | None = None) -> DataFrame:
    """(_id, _xx, p, f, near, windows): the lines that are the fingerprint of a window that counts as a run.

    near: the hashes of the lines from p - run_lines + 1 to p + run_lines - 1, null beyond the text, f in the middle.
    windows: bits of ``window_kinds``. Left out are windows all of whose lines lie in smaller ones within them: where such a window repeats, so do these.
    """
    short = long_words is not None or long_chars is not None
    norm = F.transform(F.split(F.col("_text"), "\n", -1), lambda x: F.btrim(x, F.lit(BLANK)))
    lines = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_id IS NOT NULL AND _text IS NOT NULL").withColumn("_xx", F.xxhash64("_text"))

    def facts(x):
        words = [] if long_words is None else [F.regexp_count(x, F.lit(r"\S+")).alias("w")]
        return F.struct(F.xxhash64(x).alias("h"), F.char_length(x).alias("c"), *words)

    kinds = ["h", "c", *([] if long_words is None else ["w"])]
    none = F.array_repeat(F.lit(None).cast("struct<h:bigint,c:int" + (">" if long_words is None else ",w:int>")), run_lines - 1)
    hashed = lines.select("_id", "_xx", F.transform(norm, facts).alias("_l")).select("_id", "_xx", F.size("_l").alias("_n"), F.concat(none, "_l", none).alias("l"))
    # the lines about each line as columns of its row: the lines moved by k
    mid = run_lines - 1
    places = range(2 * run_lines - 1)
    moved = [F.slice("l", k + 1, F.col("_n")).alias(f"l{k}") for k in places]
    rows = hashed.select("_id", "_xx", "_n", F.posexplode(F.arrays_zip(*moved)).alias("p", "w")).select("_id", "_xx", "_n", "p", *(F.col(f"w.l{k}.{x}").alias(f"{x}{k}") for x in kinds for k in places))

    def long(at, size):
        """Whether the lines at .. at + size - 1 are a run by their length alone."""
        held = F.lit(False)
        if long_words is not None:
            held |= sum(F.col(f"w{k}") for k in range(at, at + size)) >= long_words
        if long_chars is not None:
            held |= sum(F.col(f"c{k}") for k in range(at, at + size)) >= long_chars
        return held

    def window(size, back):
        """Whether the lines from mid - back on are in the text, count as a run, and have their first least hash at mid."""
        start = mid - back
        least = [F.col(f"h{mid}") < F.col(f"h{k}") if k < mid else F.col(f"h{mid}") <= F.col(f"h{k}") for k in range(start, start + size)]
        counts = sum(F.col(f"c{k}") for k in range(start, start + size)) >= min_chars
        if size < run_lines:
            counts = (counts & (F.col("_n") == size)) | long(start, size)
        if short and size > 1:
            inner = [(at, n) for n in range(1, size) for at in range(size - n + 1)]
            covered = (functools.reduce(operator.or_, (long(start + at, n) for at, n in inner if at <= k < at + n)) for k in range(size))
            counts &= ~functools.reduce(operator.and_, covered)
        return functools.reduce(operator.and_, least) & counts

    bits = sum(F.when(window(size, back), 1 << k).otherwise(0) for k, (size, back) in enumerate(window_kinds(run_lines, short)))
    made = rows.select("_id", "_xx", "p", F.col(f"h{mid}").alias("f"), F.array(*(f"h{k}" for k in places)).alias("near"), bits.alias("windows"))
    return made.where("windows > 0")


def repeated_runs(positions: DataFrame, run_lines: int, short: bool) -> DataFrame:
    """(_id, _xx, p, back, ahead): the lines p - back .. p + ahead stand earlier, in the order of (id, text digest, line)."""
    mid = run_lines - 1
    kinds = window_kinds(run_lines, short)
    at = F.struct("_id", "_xx", "p")
    shared = positions.groupBy("f").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).where(F.col("lo") < F.col("hi")).select("f")
    # both sides of the joins grow with the corpus, so neither is broadcast at any size
    found = positions.join(shared.hint("merge"), "f")

    def has(windows, k):
        return F.col(windows).bitwiseAND(F.lit(1 << k)) != 0

    def context(k, size, back):
        return F.when(has("windows", k), F.xxhash64(F.lit(k), *(F.col("near")[i] for i in range(mid - back, mid - back + size))))

    contexts = found.withColumn("context", F.explode(F.array_compact(F.array(*(context(k, *kind) for k, kind in enumerate(kinds))))))
    first = contexts.groupBy("f", "context").agg(F.min(F.struct("_id", "_xx", "p", "near", "windows")).alias("first"), F.max(at).alias("_last"))
    first = first.where(F.struct("first._id", "first._xx", "first.p") < F.col("_last")).select("f", "context", "first")
    pairs = contexts.join(first.hint("merge"), ["f", "context"]).where(at > F.struct("first._id", "first._xx", "first.p"))

    def extended(step):
        """How many lines on this side of the fingerprints are equal without a gap."""
        count = F.lit(mid)
        for d in range(mid, 0, -1):
            k = mid + step * d
            count = F.when(F.col("near")[k] == F.col("first.near")[k], count).otherwise(d - 1)
        return count

    matched = pairs.withColumns({"left": extended(-1), "right": extended(1)})

    def reach(side):
        inside = [has("windows", k) & has("first.windows", k) & (F.col("left") >= back) & (F.col("right") >= size - 1 - back) for k, (size, back) in enumerate(kinds)]
        return F.array_max(F.array(*(F.when(ok, side(*kind)) for ok, kind in zip(inside, kinds))))

    # all of them hold p, so what they cover together is one run
    runs = matched.select("_id", "_xx", "p", reach(lambda size, back: back).alias("back"), reach(lambda size, back: size - 1 - back).alias("ahead"))
    return runs.where("back IS NOT NULL").groupBy("_id", "_xx", "p").agg(F.max("back").alias("back"), F.max("ahead").alias("ahead"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_lines: int = 3, min_chars: int = 40, carry: tuple[str, ...] = (), long_words: int | None = None, long_chars: int | None = None) -> DataFrame:
    """Per input row: doc_id, text (without the deleted lines), n_lines, n_removed, and the ``carry`` columns.

    A line goes if it lies in a run of ``run_lines`` lines, of ``min_chars``
    characters at least, that stands earlier: in a smaller id, or before in the
    same text. Outer spaces, tabs and carriage returns don't count in comparing.
    With ``long_words`` or ``long_chars`` fewer lines are a run too, where they
    hold so many words or characters, or are a whole text of ``min_chars`` characters
    (which then goes as a copy of another whole text, or of such a run).

    Null text: null, no lines. Empty text: one line, kept. Null id: nothing
    deleted, and no source. Repeated rows (same id and text): they share their positions, so they
    don't delete from one another. Rows of one id with different texts: documents of their own, in the order of
    a digest of their texts. Very long texts: arrays in proportion to their lines. Empty table: no rows. Extra columns are
    not read unless carried.
    """
    scratch = Scratch(df.sparkSession, "lines")
    positions = scratch.write(line_positions(df, id_col, text_col, run_lines, min_chars, long_words, long_chars), "positions")
    runs = repeated_runs(positions, run_lines, long_words is not None or long_chars is not None)
    covered = F.flatten(F.collect_list(F.sequence(F.col("p") - F.col("back"), F.col("p") + F.col("ahead"))))
    gone = scratch.write(runs.groupBy("_id", "_xx").agg(F.array_sort(F.array_distinct(covered)).alias("d")), "gone")
    scratch.drop("positions")
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_xx"), *(F.col(c).alias(f"_c{k}") for k, c in enumerate(carry)))
    found = rows.join(gone.hint("merge"), ["_id", "_xx"], "left").withColumn("_lines", F.split("_text", "\n", -1))
    n = F.size("_lines")
    # keep flags in runs: what stands before the first deleted line, then each deleted line and the gap after it
    following = F.concat(F.slice("d", F.lit(2), F.size("d")), F.array(n))

    def flags_from(s, t):
        return F.concat(F.array_repeat(F.lit(False), F.least(F.lit(1), t - s)), F.array_repeat(F.lit(True), F.greatest(F.lit(0), t - s - 1)))

    flags = F.concat(F.array_repeat(F.lit(True), F.get("d", F.lit(0))), F.flatten(F.zip_with("d", following, flags_from)))
    # what stands in a lambda is computed for every element, so arrays meet as arguments only
    flagged = F.zip_with("_lines", flags, lambda x, k: F.struct(x.alias("x"), k.alias("k")))
    left = F.transform(F.filter(flagged, lambda p: F.coalesce(p["k"], F.lit(True)) & p["x"].isNotNull()), lambda p: p["x"])
    done = found.withColumn("_left", F.when(F.col("d").isNotNull(), left).otherwise(F.col("_lines")))
    return done.select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("d").isNotNull(), F.array_join("_left", "\n")).otherwise(F.col("_text")).alias("text"),
        F.when(F.col("_text").isNull(), 0).otherwise(n).cast("long").alias("n_lines"),
        F.when(F.col("d").isNull() | F.col("_text").isNull(), 0).otherwise(n - F.size("_left")).cast("long").alias("n_removed"),
        *(F.col(f"_c{k}").alias(c) for k, c in enumerate(carry)),
    )


def oracle(run_lines: int = 3, min_chars: int = 40, long_words: int | None = None, long_chars: int | None = None) -> str:
    """DuckDB SQL for doc_id, n_lines, n_removed and the digest of the remaining text over ``documents`` with unique ids."""

    def window(size):
        def over(name, glue):
            return glue.join([name, *(f"lead({name}, {k}) OVER w" for k in range(1, size))])

        chars = over("length(norm)", " + ")
        counts = f"{chars} >= {min_chars}"
        if size < run_lines:
            more = [f"{over('words', ' + ')} >= {long_words}"] * (long_words is not None) + [f"{chars} >= {long_chars}"] * (long_chars is not None)
            counts = " OR ".join([f"({counts} AND cnt = {size})", *more])
        return f"SELECT doc_id, n, {size} AS k, {over('norm', ' || chr(10) || ')} AS gram, {counts} AS counts FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY n)"

    sizes = range(run_lines if long_words is None and long_chars is None else 1, run_lines + 1)
    return f"""
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL
), cut AS (
  SELECT doc_id, len(ls) AS cnt, i - 1 AS n, ls[i] AS line, trim(ls[i], ' ' || chr(9) || chr(13)) AS norm
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM split)
), lines AS (
  SELECT *, len(regexp_extract_all(norm, '[^\\x20\\x09-\\x0D]+')) AS words FROM cut
), grams AS (
  {" UNION ALL ".join(map(window, sizes))}
), dated AS (
  SELECT doc_id, n, k, row_number() OVER (PARTITION BY k, gram ORDER BY doc_id, n) AS place FROM grams WHERE gram IS NOT NULL AND counts
), gone AS (
  SELECT DISTINCT doc_id, n + d AS n FROM dated, range({run_lines}) r(d) WHERE place > 1 AND d < k
), flagged AS (
  SELECT l.doc_id, l.n, l.line, g.n IS NOT NULL AS gone FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
"""
