"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every round points the larger
neighbours (then the smaller ones) of each node to the smallest one it knows,
until every node points at the smallest of its component.  Each round is two
aggregations with map-side minima and two equi-joins, so a node with very many
neighbours is never gathered; hot join keys are split by Spark.  Rounds are cut
off by ``checkpoint()`` in the shared checkpoint folder.  A round has tasks for
the edges that are left, as every task of a round writes files to each shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickwave.session import checkpoint_dir

MAX_ROUNDS = 60
ROWS_PER_TASK, LEAST_TASKS = 50_000, 8


def _star(edges: DataFrame) -> DataFrame:
    """``edges``: (u, v), each v a neighbour of u: link them, and u, to the smallest."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node, component``: the smallest node of the component of every node
    that has an edge to another node.  Nodes are integers; edges may repeat,
    loop and go either way; no edges give no rows."""
    checkpoint_dir(edges.sparkSession)
    hi, lo = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    now = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(hi, lo).distinct().checkpoint()
    mark = _mark(now)
    if not mark[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        tasks = max(LEAST_TASKS, -(-mark[0] // ROWS_PER_TASK))
        both = now.coalesce(tasks).select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        large = (_star(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .coalesce(tasks))
        now = (_star(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
               .where(F.col("u") != F.col("v")).coalesce(tasks).distinct().coalesce(tasks).checkpoint())
        before, mark = mark, _mark(now)
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
