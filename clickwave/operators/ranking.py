"""Ranking (T1-T5) and ranking reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwave.functions.formatting import ITEM_LABELS, ranking_report


def top_n(df: DataFrame, partition_by: list[str], order_by: list[Column | str], n: int,
          rank_col: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows per partition.

    ``row_number() <= n`` lets Catalyst plan a partial ``WindowGroupLimit``
    before the shuffle, so at most ``n`` rows per partition key leave each
    map task even when one key (window) is huge.  Ties are broken by the
    trailing order columns (D2: key ascending).
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def top_n_by_count(df: DataFrame, window_col: str, key: str, cnt: str, n: int,
                   rank_col: str = "rank") -> DataFrame:
    """Top ``n`` keys per window by count descending, key ascending on ties."""
    return top_n(df, [window_col], [F.desc(cnt), F.asc(key)], n, rank_col)


def ranking_reports(ranked: DataFrame, window_col: str, key: str, cnt: str,
                    rank_col: str = "rank", labels: tuple[str, str] = ITEM_LABELS,
                    out: str = "report") -> DataFrame:
    """One text block per window from an already limited ranking."""
    entries = F.collect_list(F.struct(F.col(rank_col).alias("rank"), F.col(key).alias("key"),
                                      F.col(cnt).alias("cnt")))
    return (ranked.groupBy(window_col).agg(entries.alias("_e"))
            .select(window_col, ranking_report(F.col(window_col), F.col("_e"), labels).alias(out)))
