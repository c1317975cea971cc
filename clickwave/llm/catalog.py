"""Registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.llm import oracles
from clickwave.llm.common import bounded_batches
from clickwave.llm.embedding_dedup import near_embeddings
from clickwave.llm.fill_in_middle import fill_in_middle_digests
from clickwave.llm.html_extract import main_text
from clickwave.llm.importance_resampling import resampled
from clickwave.llm.line_dedup import deduplicated_lines
from clickwave.llm.minhash_dedup import near_documents
from clickwave.llm.mixing import mix_sources
from clickwave.llm.packing import pack_documents
from clickwave.llm.token_counts import token_counts
from clickwave.llm.token_output import packed_matrices
from clickwave.llm.topk_search import top_k
from clickwave.llm.toxicity import score_documents, train
from clickwave.llm.warc import archived_pages
from clickwave.sources.events import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _over(table: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(read_table(bounded_batches(spark), sf_dir, table))
    run.__name__ = operator.__name__
    return run


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(bounded_batches(spark), sf_dir, "documents")
    return score_documents(docs, train(docs, read_table(spark, sf_dir, "labels")))


def _topk(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, F.col("id") % 100 == 0)


def _resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(bounded_batches(spark), sf_dir, "documents")
    return resampled(docs, read_table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": _over("documents", token_counts),
    "op2_embedding_dedup": _over("embeddings", near_embeddings),
    "op3_topk_search": _over("embeddings", _topk),
    "op4_html_extraction": _over("pages", main_text),
    "op5_packing": _over("documents", pack_documents),
    "op6_minhash_dedup": _over("documents", near_documents),
    "op7_line_dedup": _over("documents", deduplicated_lines),
    "op8_token_output": _over("documents", packed_matrices),
    "op9_toxicity": _toxicity,
    "op10_mixing": _over("documents", mix_sources),
    "op11_warc": _over("pages", archived_pages),
    "op12_importance_resampling": _resampled,
    "op13_fill_in_middle": _over("documents", fill_in_middle_digests),
}

ORACLES: dict[str, str] = {
    "op2_embedding_dedup": oracles.EMBEDDING_DEDUP,
    "op3_topk_search": oracles.TOPK_SEARCH,
    "op6_minhash_dedup": oracles.MINHASH_DEDUP,
    "op7_line_dedup": oracles.LINE_DEDUP,
    "op10_mixing": oracles.MIXING,
    "op11_warc": oracles.WARC,
    "op12_importance_resampling": oracles.IMPORTANCE_RESAMPLING,
    "op13_fill_in_middle": oracles.FILL_IN_MIDDLE,
}
