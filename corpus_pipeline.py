"""The corpus pipeline over ``documents``: filter, deduplicate, mix, pack.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.  The
stages of one run follow each other through tables in the shared folder, so a
lost executor repeats the tasks of one stage only, and every stage sees the
same rows however often it reads them.

An empty table passes through all stages.  What a stage does with nulls,
repeated rows and the like is said in the docstring of its operator.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickwave.llm.common import bounded_batches
from clickwave.llm.line_dedup import without_recurring_lines
from clickwave.llm.minhash_dedup import one_of_each_group
from clickwave.llm.mixing import take_copies
from clickwave.llm.packing import pack_documents
from clickwave.llm.toxicity import train, without_toxic
from clickwave.session import checkpoint_dir
from clickwave.sources.events import read_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field, learned from the labels, does not find toxic."""
    bounded_batches(spark)
    return without_toxic(docs, train(docs, read_table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that recur across them."""
    return without_recurring_lines(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return take_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    bounded_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("minhash_dedup", minhash_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL expresses neither the field nor the subset-sum packing; tests/llm holds
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; the last one's rows."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline/{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(docs.schema).parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
