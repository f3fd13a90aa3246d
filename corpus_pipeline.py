"""The corpus pipeline: toxicity, line dedup, MinHash near-dedup, suffix-array dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what a stage
returns is written as Parquet in the shared folder and read again as the next
one's ``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hashloom.llm.common import Scratch, load
from hashloom.llm.line_dedup import LONG_CHARS, LONG_WORDS, line_dedup
from hashloom.llm.minhash_dedup import near_duplicates
from hashloom.llm.packing import pack
from hashloom.llm.suffix_dedup import remove_repeats
from hashloom.llm.toxicity import score, train

OTHERS = ("lang", "source")


def _documents(rows: DataFrame, cut) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now; texts that were ``cut`` and of which nothing is left go."""
    left = F.length(F.trim(F.coalesce("text", F.lit("")))) > 0
    return rows.where(left | ~cut).select("doc_id", "text", "lang", "source", F.char_length("text").cast("long").alias("n_chars"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of any toxic grade is below one half.

    Null, empty and wordless texts are rated as having no words; rows with a null id are rated too. Repeated rows are rated each. Very long texts are rated whole. An empty table stays empty; columns
    other than those of ``documents`` are left out.
    """
    rated = score(docs, train(docs, load(spark, sf_dir, "labels")), carry=("text", "lang", "source", "n_chars"))
    return rated.where(~F.col("toxic")).select("doc_id", "text", "lang", "source", "n_chars")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that stand earlier; those of which nothing but blanks is left go.

    Null and empty texts stay as they are. Rows with a null id lose nothing and are no source. Repeated rows (same id and text) share their lines and don't delete
    from one another; several texts of one id are documents of their own. Long texts are worked whole. An empty table stays empty; other columns are left out.
    """
    return _documents(line_dedup(docs, carry=OTHERS, long_words=LONG_WORDS, long_chars=LONG_CHARS), F.col("n_removed") > 0)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    A row goes by its own text: another text under the same id stays. Null and empty texts, and rows with a null id, are in no group and stay.
    Repeated rows (same id and text) stay or go together. Ties: a pair at exactly 80 percent is linked. An empty table stays empty; other columns are left out.
    """
    gone = near_duplicates(docs, percent=80).where(~F.col("kept")).select("doc_id", F.col("text_xxhash64").alias("_xx")).distinct()
    marked = docs.withColumn("_xx", F.xxhash64(F.coalesce("text", F.lit(""))))
    return marked.join(gone, ["doc_id", "_xx"], "left_anti").select("doc_id", "text", "lang", "source", "n_chars")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the characters of passages that stand in an earlier document; those of which nothing but blanks is left go.

    Whole characters go where a byte of them does. Null and empty texts, and rows with a null id, stay as they are. Matches never cross documents; several texts of one id, and repeated rows, are cut each for what smaller ids hold. Very long texts are cut over tasks. An empty
    table stays empty; other columns are left out.
    """
    cut = remove_repeats(docs.withColumn("_null", F.col("text").isNull()), whole_characters=True, carry=(*OTHERS, "_null"))
    return _documents(cut.withColumn("text", F.when(~F.col("_null"), F.col("kept").cast("string"))), F.size("spans") > 0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences.

    A null or empty text is a document of one end token. Repeated rows are packed each. A long text is cut into pieces. An empty table gives no pieces; other columns are left out.
    """
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", lines),
    ("MinHash near-dedup", near),
    ("suffix-array dedup", repeats),
    ("packing", packing),
]

#: The stages learn a model, follow components and tokenise: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
