"""A corpus pipeline of five operators: what enters is `documents`, what leaves are packed pieces.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor kept
and returns a frame that is written and read again as the next one's docs. All but the
last return the columns of `documents`. No stage leaves work out at any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.llm.columns import hidden, position, table, written
from lendmill.llm.mixing import mix
from lendmill.llm.packing import pack
from lendmill.llm.quality_rules import judge
from lendmill.llm.simhash import keep_one
from lendmill.llm.substring_dedup import substring_dedup


# Operators work on columns under hidden names here, so that a column of `documents`
# named like a result, `kept` or `times`, goes through unchanged.


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or that the vote model takes for bad go."""
    inner, text = hidden(docs), position(docs, "text")
    return judge(inner, text).where("kept").select(inner.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays."""
    return keep_one(docs, "doc_id", "text")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in passages that also stand elsewhere go; a text without any stays as it was.

    A document that consisted of such passages only goes. `n_chars` follows the text.
    """
    inner, text, n_chars = hidden(docs), position(docs, "text"), position(docs, "n_chars")
    cut = substring_dedup(inner, text, join_clean=False)
    cut = cut.where("n_removed = 0 OR n_removed < n_words")
    length = F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col(n_chars))
    cut = cut.withColumn(n_chars, length.cast(inner.schema[n_chars].dataType))
    return cut.select(inner.columns).toDF(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document stands as often as the mix takes it, which may be not at all."""
    inner = hidden(docs)
    taken = mix(inner, position(docs, "text"), position(docs, "source")).where("times > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    return taken.select(*inner.columns, copies).drop("copy").toDF(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in which bin."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing", mixture),
    ("best-fit packing", packed),
]

#: Fingerprints, the mix and the packing are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
