"""From documents to packed sequences: five stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns
of ``documents``. Each is written as Parquet and read again by the next one, so a lost
executor never costs more than the stage at hand.

In every stage null texts count as empty ones, rows without an id are told apart by their
texts, an empty table stays empty, and all columns of the documents are kept, whatever their
names. Of rows that repeat id and text the first two stages keep all or none, the third one.
Ties between copies go to the least id, then to the least hash of the text.

In every stage null texts count as empty ones, a null id is an id of its own kind, an empty
table stays empty, and all columns of the documents are kept, whatever their names. Of rows
that repeat id and text the first two stages keep all or none, the third one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newslens.llm import ngram_join, packing, quality, suffix_dedup, toxicity
from newslens.llm.common import table
from newslens.llm.queries import vocabulary
from newslens.session import drop_table, new_table_path

#: No SQL expresses the learned stages.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, rejects go."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, fitted on the labelled ones among them, rejects go."""
    return quality.without_poor(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays."""
    return ngram_join.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus are cut out of the later documents."""
    return suffix_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of a fixed length."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's table, written and read again like the others.

    The table of a stage is deleted when the next one is written; the last one stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_table(spark, before)
        before = path
    return docs
