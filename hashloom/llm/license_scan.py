"""License scans by diagonal voting (DataFrame operations only).

All rolling word k-grams of every text join the template positions that hold the
same k-gram: three words in templates of ``LONG`` words or more, two in shorter ones (and for the deciding words of all). A hit at text word i and template word j votes for the diagonal
i - j. Votes are summed per diagonal; nothing is dropped for having few. Neighbouring diagonals of one template, those within a quarter of its
length, merge around the one that gathers the most votes, which bridges inserted and missing words. The merged span is verified: it counts if
the words that its k-grams cover are enough of the template, and it holds every deciding pair (the version, the
word that tells one license from the other). Spans that overlap compete: the one that covers the most words stays.
Phrases are short templates that must stand unbroken on one diagonal, and don't compete.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower
from .license_templates import PHRASES, templates

WORD_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Words from which a template is indexed by three words instead of two.
LONG = 25
#: A vote's number is the template position times this, plus the words of its k-gram.
CODE = 4
#: Template positions up to which they are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 50_000

HIT = "template int, phrase boolean, label string, size int, need array<int>, code int, g1 string, g2 string, g3 string"


def plain_words(text: str) -> list[str]:
    """The words of a template, as ``words_of`` has those of a column."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(WORD_BREAK, lower) if w]


def template_grams(phrases=PHRASES, notices=None) -> list[tuple]:
    """One row per indexed k-gram: (template, phrase, label, words, votes that decide, vote, its words; null for none)."""
    rows = []
    given = [(label, (), text, True) for text, label in phrases] + [(*n, False) for n in (templates() if notices is None else notices)]
    for t, (label, deciding, text, phrase) in enumerate(given):
        words = plain_words(text)
        if len(words) < 2:
            raise ValueError(f"a template needs two words: {text!r}")
        need = set()
        for d in map(plain_words, deciding):
            at = [j for j in range(len(words)) if words[j : j + len(d)] == d]
            if not at or len(d) < 2:
                raise ValueError(f"{' '.join(d)!r} must be words of {text!r}")
            need.update(range(at[0], at[0] + len(d) - 1))
        long = len(words) >= LONG
        grams = [(j, 3) for j in range(len(words) - 2)] if long else []
        grams += [(j, 2) for j in range(len(words) - 1) if not long or j in need]
        rows += [(t, phrase, label, len(words), sorted(CODE * j + 2 for j in need), CODE * j + k, *(words[j : j + k] + [None])[:3]) for j, k in grams]
    return rows


def words_of(text):
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def license_hits(df: DataFrame, id_col="doc_id", text_col="text", phrases=PHRASES, notices=None, slack: int = 2, coverage: float = 0.75) -> DataFrame:
    """Verified spans: _id, _xx, phrase, label, first (its first word), last (its last word), share (of the template's words).

    Null or empty text: no spans. Null ids: a value like any other. Repeated rows (same id and text) vote once. Very long texts: their words are one
    array in a task. Repeats of a template of few words that stand two words apart are one span. Empty table: no rows.
    """
    spark = df.sparkSession
    rows = template_grams(phrases, notices)
    index = spark.createDataFrame(rows, HIT).withColumn("h", F.when(F.col("g3").isNull(), F.xxhash64("g1", "g2")).otherwise(F.xxhash64("g1", "g2", "g3")))
    if len(rows) <= BROADCAST_ROWS:
        index = F.broadcast(index)
    docs = df.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_xx"), words_of(F.col(text_col)).alias("_words"))
    more = [F.slice("_words", F.lit(k), F.size("_words")).alias(f"w{k}") for k in (2, 3)]
    grams = docs.where(F.size("_words") > 1).select("_id", "_xx", F.posexplode(F.arrays_zip(F.col("_words").alias("w1"), *more)).alias("i", "p"))
    grams = grams.select("_id", "_xx", "i", "p.w1", "p.w2", "p.w3").where("w2 IS NOT NULL")
    # a text shorter than three words, and a text's end, has no third word; no template's three words hash as with a null
    hashed = grams.select("*", F.explode(F.array(F.xxhash64("w1", "w2"), F.xxhash64("w1", "w2", "w3"))).alias("h"))
    same = (F.col("w1") == F.col("g1")) & (F.col("w2") == F.col("g2")) & (F.col("g3").isNull() | (F.col("w3") == F.col("g3")))
    key = ["_id", "_xx", "template", "phrase", "label", "size", "need"]
    j = F.floor(F.col("code") / CODE).cast("int")
    votes = hashed.join(index, "h").where(same).select(*key, "code", (F.col("i") - j).alias("diag"))
    # a set of votes, so repeated rows vote once
    diagonals = Scratch(spark, "license").write(votes.groupBy(*key, "diag").agg(F.collect_set("code").alias("codes")), "diagonals")
    whole = diagonals.where("phrase AND size(codes) = size - 1")
    unbroken = whole.select(*key[:2], "template", "phrase", "label", F.col("diag").alias("first"), (F.col("diag") + F.col("size") - 1).alias("last"), F.lit(1.0).alias("share"), F.col("size").alias("votes"))
    reach = F.greatest(F.lit(slack), F.floor(F.col("size") / 4).cast("int"))
    # diagonals in units of a millionth of the reach, so that one frame serves all templates; the one unit more is for rounding
    near = Window.partitionBy("_id", "_xx", "template").orderBy(F.col("diag").cast("double") * 1_000_000 / reach).rangeBetween(-1_000_001, 1_000_001)
    ranked = diagonals.where(~F.col("phrase")).withColumn("sum", F.sum(F.size("codes")).over(near))
    ranked = ranked.withColumn("top", F.max(F.struct("sum", F.size("codes"), -F.col("diag"))).over(near))
    # a k-gram covers three words at most, so fewer votes can't cover enough
    enough_votes = F.col("sum") * 3 >= F.col("size") * coverage
    peaks = ranked.where(enough_votes & (F.col("top") == F.struct("sum", F.size("codes"), -F.col("diag")))).select("_id", "_xx", "template", F.col("diag").alias("peak"))
    around = ranked.drop("sum", "top").alias("r").join(peaks.alias("p"), F.col("r._id").eqNullSafe(F.col("p._id")) & (F.col("r._xx") == F.col("p._xx")) & (F.col("r.template") == F.col("p.template")) & (F.abs(F.col("diag") - F.col("peak")) <= reach))
    each = around.select(*(f"r.{c}" for c in key), "peak", "diag", F.explode("codes").alias("code"))
    nearest = each.groupBy(*key, "peak", "code").agg(F.min(F.struct(F.abs(F.col("diag") - F.col("peak")).alias("off"), "diag")).alias("at"))
    k = F.col("code") % CODE
    i = F.col("at.diag") + j
    spans = nearest.groupBy(*key, "peak").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence(j, j + k - 1))))).alias("covered"), F.min(i).alias("first"), F.max(i + k - 1).alias("last"), F.collect_set("code").alias("codes")
    )
    share = F.col("covered") / F.col("size")
    enough = (share >= coverage) & (F.col("last") - F.col("first") < 1.5 * F.col("size") + slack) & (F.size(F.array_except("need", "codes")) == 0)
    hits = spans.where(enough).select(*key[:2], "template", "phrase", "label", "first", "last", share.alias("share"), F.col("covered").alias("votes"))
    found = ["_id", "_xx", "phrase", "label", "first", "last", "share"]
    return _best(hits).select(*found).unionByName(unbroken.select(*found))


def _best(hits: DataFrame) -> DataFrame:
    """Of spans that overlap, the one that covers the most words, and those that do not overlap it."""
    doc = Window.partitionBy("_id", "_xx", "phrase")
    along = doc.orderBy("first", "last", "template")
    before = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    chain = F.sum(F.when(before.isNull() | (F.col("first") > before), 1).otherwise(0)).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chained = hits.withColumn("chain", chain)
    best = F.max(F.struct("votes", "share", -F.col("first"), -F.col("template"), F.col("first").alias("from"), F.col("last").alias("to"), "template")).over(Window.partitionBy("_id", "_xx", "phrase", "chain"))
    held = chained.withColumn("best", best)
    own = (F.col("template") == F.col("best.template")) & (F.col("first") == F.col("best.from")) & (F.col("last") == F.col("best.to"))
    clear = (F.col("first") > F.col("best.to")) | (F.col("last") < F.col("best.from"))
    return held.where(own | clear)


def license_scan(df: DataFrame, id_col="doc_id", text_col="text", phrases=PHRASES, notices=None, slack: int = 2, coverage: float = 0.75) -> DataFrame:
    """Per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts every place where a phrase stands; first_word and last_word
    are the smallest and largest start of such places (words from 0, else
    null). labels adds the notices found; score is the largest share of a
    template covered (1 for a phrase), 0 without any.

    Null or empty text: no words, empty labels. Repeated rows (same id and
    text): each is returned with the same figures. Rows of one id with
    different texts are told apart by their texts. Null id: a value like any other. Very long texts:
    their words are one array in a task. Ties between overlapping spans: the greater share, then the earlier, then the
    earlier template. ``notices``: templates as in ``license_templates``, by default all of these. Empty table:
    no rows. Extra columns are not read, whatever their names.
    """
    hits = license_hits(df, id_col, text_col, phrases, notices, slack, coverage)
    base = F.col("phrase")
    summed = hits.groupBy("_id", "_xx").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    docs = df.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_xx"),
        F.size(words_of(F.col(text_col))).cast("long").alias("n_words"),
    )
    found = docs.alias("d").join(summed.alias("s"), F.col("d._id").eqNullSafe(F.col("s._id")) & (F.col("d._xx") == F.col("s._xx")), "left")
    return found.select(
        F.col("d._id").alias("doc_id"),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
