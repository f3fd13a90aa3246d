"""Divergence audit of sources by count-level bitmaps.

The terms of a language are numbered by their counts. A group (language, source) has one bitset of term numbers per
count that its terms have, stored as 64-bit words with a bit set. Two groups' joint cell (c1, c2), the number of terms that
occur c1 times here and c2 times there, is the bits that the two bitsets share: AND and popcount, word by word. A cell
weighs its number times the term divergence f(c1, c2), so a pair's divergence costs the levels in a word and not the terms. Cells with a zero
follow by complement, from the marginal counts of the levels.

Neighbouring numbers have alike counts, so a word has few levels. Words are the unit of work: the language and the word number deal the join, and one
large source is spread over all of them.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, load, numbered, small_side, text_views

#: Every byte that is in no term becomes a space; letters become lower case.
TERM_BYTES = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
#: Documents of a language that a kept term stands in at least.
MIN_DOCS = 10
#: Ranks of the part ``term``.
TOP = 10
#: Bytes of a text whose words are in memory at once, and (group, term) entries that a task gathers before it hands them on.
BLOCK, GATHERED = 1 << 20, 200_000


def _terms(text: bytes, count: Counter) -> set:
    """Adds a text's terms to ``count`` and returns the different ones."""
    if len(text) <= BLOCK:
        words = text.translate(TERM_BYTES).split()
        count.update(words)
        return set(words)
    seen, at = set(), 0
    while at < len(text):
        block = text[at : at + BLOCK].translate(TERM_BYTES)
        cut = len(block) if at + BLOCK >= len(text) else block.rfind(b" ") + 1
        if not cut:  # one term fills the block: on to its end
            block = text[at:].translate(TERM_BYTES)
            cut = block.find(b" ") + 1 or len(block)
        words = block[:cut].split()
        count.update(words)
        seen.update(words)
        at += cut
    return seen


def term_counts(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): partial sums a task; a row with a null term for every group that occurs."""

    def run(batches):
        found: dict = defaultdict(lambda: (Counter(), Counter()))

        def rows():
            columns: list = [[], [], [], [], []]
            for (lang, source), (count, docs) in found.items():
                terms = list(count)
                for column, values in zip(columns, ([lang] * (len(terms) + 1), [source] * (len(terms) + 1), [None, *(t.decode() for t in terms)], [0, *count.values()], [0, *(docs[t] for t in terms)]), strict=True):
                    column.extend(values)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "term", "n", "docs"])

        held = 0
        for batch in batches:
            raw, starts, _ = text_views(batch, "t")
            data, at = raw.tobytes(), starts.tolist()
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                count, docs = found[key]
                before = len(count)
                docs.update(_terms(data[at[i] : at[i + 1]], count))
                held += len(count) - before
                if held >= GATHERED:
                    yield rows()
                    found.clear()
                    held = 0
        if found:
            yield rows()

    plain = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "t"))))
    return plain.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _p(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * v)), exact."""
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = F.greatest(total + 2 * v, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def levels(kept: DataFrame) -> DataFrame:
    """(lang, source, c, w, bits): word w of the bitset of the terms that stand c times in the group. kept: lang, source, n, pos."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(F.lit(63)).cast("int"))
    return kept.groupBy("lang", "source", F.col("n").alias("c"), F.shiftright("pos", 6).alias("w")).agg(F.bit_or(bit).alias("bits"))


def pair_values(words: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of groups of a language. words: as ``levels`` has them; groups: lang, source, total, v."""
    side = groups.select("lang", F.col("source").alias("item"), F.col("total").alias("total2"))
    v, zero = F.col("v"), F.lit(0)

    def f(c1, c2):
        return _f(_p(c1, F.col("total"), v), _p(c2, F.col("total2"), v))

    small = small_side(groups)
    small2 = small_side(side)
    pairs = groups.join(small2, "lang").where("source <> item")
    base = pairs.select("lang", "source", "item", F.when(v > 0, v * f(zero, zero)).otherwise(0).alias("x"))
    # a level's terms, as if none of them were in the other group
    marginal = words.groupBy("lang", "source", "c").agg(F.sum(F.bit_count("bits")).alias("n"))
    alone = marginal.join(small, ["lang", "source"]).join(small2, "lang").where("source <> item").select("lang", "source", "item", (F.col("n") * (f(F.col("c"), zero) - f(zero, zero))).alias("x"))
    # the joint cells, less what was counted for them above
    other = words.select("lang", "w", F.col("source").alias("item"), F.col("c").alias("c2"), F.col("bits").alias("bits2"))
    shared = F.col("bits").bitwiseAND(F.col("bits2"))
    cells = words.hint("merge").join(other, ["lang", "w"]).where((F.col("source") < F.col("item")) & (shared != 0)).groupBy("lang", "source", "item", "c", "c2").agg(F.sum(F.bit_count(shared)).alias("n"))
    c, c2 = F.col("c"), F.col("c2")
    joint = cells.join(small, ["lang", "source"]).join(small2, ["lang", "item"]).select("lang", "source", "item", (F.col("n") * (f(c, c2) - f(c, zero) - f(zero, c2) + f(zero, zero))).alias("x"))
    one_way = alone.unionByName(joint)
    both = base.unionByName(one_way).unionByName(one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "x"))
    return both.groupBy("lang", "source", "item").agg(F.sum("x").alias("value"))


def divergence_audit(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from the others of its language, and by which terms.

    Part ``pair``: each other source of the language, with the divergence summed over all kept terms. Part ``term``: the ``top``
    terms that the source has more of than its language. Ranks by value, greatest first; ties by item in UTF-8 order.

    Null text, language or source: as empty, so a null and an empty one are the same. A group without terms, or a language without
    kept ones: compared all the same (value 0 where no term is kept); a language with one source has no pairs. Repeated
    rows and rows of one id: documents of their own. Very long texts: a megabyte of words in memory at
    a time. Empty table: no rows. Extra columns are not read.
    """
    scratch = Scratch(df.sparkSession, "divergence")
    counts = scratch.write(term_counts(df, lang_col, source_col, text_col).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    known = counts.where("term IS NOT NULL")
    vocabulary = known.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).drop("docs")
    vocabulary = scratch.write(numbered(scratch, vocabulary, "lang", ["lang_n", "term"], "terms", "v"), "vocabulary")
    kept = scratch.write(known.drop("docs").join(vocabulary.hint("merge"), ["lang", "term"]), "kept")
    langs = vocabulary.groupBy("lang").agg(F.max("v").alias("v"), F.sum("lang_n").alias("lang_total"))
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term IS NULL").select("lang", "source").join(langs, "lang", "left").join(sums, ["lang", "source"], "left")
    groups = scratch.write(groups.fillna(0, ["v", "lang_total", "total"]), "groups")
    words = scratch.write(levels(kept), "levels")
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    pairs = pair_values(words, groups.select("lang", "source", "total", "v")).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    p, q = _p(F.col("n"), F.col("total"), F.col("v")), _p(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    told = kept.drop("v").join(small_side(groups), ["lang", "source"]).withColumns({"_p": p, "_q": q}).where("_p > _q")
    terms = told.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _f(F.col("_p"), F.col("_q")).alias("value")).withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)
    return pairs.unionByName(terms)


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence_audit(load(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents
), v AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(words)) AS term FROM d) GROUP BY lang, term HAVING count(*) >= 10
), o AS (
  SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(words) AS term FROM d) SEMI JOIN v USING (lang, term) GROUP BY lang, source, term
), g AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM o WHERE o.lang = x.lang AND o.source = x.source), 0) AS total, (SELECT count(*) FROM v WHERE v.lang = x.lang) AS size FROM (SELECT DISTINCT lang, source FROM d) x
), p AS (
  SELECT g.lang, g.source, v.term, coalesce(o.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 2) // (g.total + 2 * g.size)::HUGEINT AS p
  FROM g JOIN v ON v.lang = g.lang LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.term = v.term
), q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 2) // (sum(sum(n)) OVER w + 2 * count(*) OVER w)::HUGEINT AS q FROM o GROUP BY lang, term WINDOW w AS (PARTITION BY lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, CAST(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS BIGINT) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT p.lang, p.source, p.term AS item, CAST((p.p - q.q) * (p.p - q.q) // (p.p + q.q) AS BIGINT) AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms QUALIFY rank <= 10
"""
