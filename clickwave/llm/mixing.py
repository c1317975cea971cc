"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: a share of all words by weight,
at most ``max_repeats`` times its own words, the excess reshared by weight.
Within a source a document is to be taken ``e`` times on average, in
proportion to its grade (the binary digits of its size, so that long documents
are preferred mildly), at most ``max_repeats`` times, such that the words
expected of the source are its target.  The whole part of ``e`` is taken for
certain, the rest ``p`` is the document's inclusion probability in a sample:
documents are ranked by random odds divided by inclusion odds,
``u/(1-u) : p/(1-p)``, and taken from the front until the words of the source
are reached.  The document at the front that does not fit is passed over; if
the sample is then short by more than ``NEAR`` of the target, the next in turn
that fit are taken, which favours a few short documents in each source.

Scale: grades have at most 64 values, so inclusion odds follow from a table of
(source, grade).  Per source only sums over buckets of the ranking variable
``v = q/(1+q)``, ``q`` the quotient of the odds, are ordered.  The ranking
itself is done in the one bucket per source in which the target falls.  For
any ``p`` the density of ``v`` is at most 1 around 1/2, where the target falls
in a large source, so that bucket stays small whatever the size of the source;
a source with a third of all rows is never sorted as a whole, and documents
are not shuffled.

Defined results:

* null text, or text without words: size 0, takes 0 words; null id: one id
  like any other; null source: a source of its own, ordered last.
* repeated rows (same id, source and size) share their random number and are
  taken together.  Ties of the ranking are ordered by id, then size.
* empty table, or one without words: every target is 0, nothing is taken.
* extra columns are kept by :func:`take_copies` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickwave.llm.common import small_side

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
DOCS_PER_BUCKET = 200
MAX_BUCKETS = 1 << 20
#: Rows up to which the tables of sources and of bucket members are broadcast.
SMALL_ROWS = 100_000
SEED = "mix"
#: Share of a source's target by which its sample may fall short; only beyond
#: it do documents out of the ranking's turn fill the gap.
NEAR = 0.001


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unit_random(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def grade(size: Column) -> Column:
    """What a document's expected copies are proportional to: the number of
    binary digits of its size."""
    return F.length(F.bin(size)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``source, n_docs, source_size, target`` and its
    ``grades``, an array of (grade, words).

    Water filling: with sources ordered by capacity over weight, a source is
    full when its capacity is below its share of what the earlier ones leave;
    the first source that is not full fixes the level for all that follow.
    """
    per = (sized.groupBy("source", grade(F.col("size")).alias("grade"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
           .groupBy("source").agg(F.sum("n").alias("n_docs"), F.sum("words").alias("source_size"),
                                  F.collect_list(F.struct("grade", "words")).alias("grades")))
    everything = W.partitionBy()
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = (per
           .withColumn("pos", F.row_number().over(by_name))
           .withColumn("weight", F.element_at(cycle, (F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1).cast("int")))
           .withColumn("cap", F.col("source_size") * F.lit(max_repeats)))
    before = W.orderBy(F.col("cap") / F.col("weight"), "pos").rowsBetween(W.unboundedPreceding, -1)
    per = (per
           .withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                       / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
           .withColumn("full", F.col("cap") / F.col("weight") <= F.col("level")))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.least(level * F.col("weight"), F.col("cap").cast("double")))
    return per.withColumn("target", target).select("source", "n_docs", "source_size", "target", "grades")


def _with_plan(sources: DataFrame, max_repeats: int) -> DataFrame:
    """One row per source and grade: copies for certain (``whole``), inclusion
    probability ``p`` of one more, and the words left to sample (``rest``).

    Water filling again: the grades of a source that reach ``max_repeats``
    copies are its highest, the others share what these leave.
    """
    per = sources.select("source", "n_docs", "source_size", "target", F.inline("grades"))
    whole_source = W.partitionBy("source")
    before = whole_source.orderBy(F.col("grade").desc()).rowsBetween(W.unboundedPreceding, -1)
    weight, cap = F.col("grade") * F.col("words"), F.col("words") * F.lit(max_repeats)
    per = per.withColumn("level", F.try_divide(
        F.col("target") - F.coalesce(F.sum(cap).over(before), F.lit(0)),
        (F.sum(weight).over(whole_source) - F.coalesce(F.sum(weight).over(before), F.lit(0))).cast("double")))
    level = F.max(F.when(F.col("level") * F.col("grade") < max_repeats, F.col("level"))).over(whole_source)
    times = (F.when(F.col("words") == 0, 0.0)
             .otherwise(F.least(F.coalesce(level * F.col("grade"), F.lit(float(max_repeats))), F.lit(float(max_repeats)))))
    buckets = F.greatest(F.lit(1), F.least(F.ceil(F.col("n_docs") / DOCS_PER_BUCKET), F.lit(MAX_BUCKETS))).cast("long")
    certain = F.sum(F.col("whole") * F.col("words")).over(whole_source)
    return (per.withColumn("times", times)
            .withColumn("whole", F.floor(F.col("times") + F.lit(1e-12)).cast("long"))
            .withColumn("p", F.greatest(F.col("times") - F.col("whole"), F.lit(0.0)))
            .withColumn("rest", F.greatest(F.col("target") - certain, F.lit(0.0)))
            .withColumn("buckets", buckets)
            .select("source", "grade", "source_size", "target", "whole", "p", "rest", "buckets"))


def _ranked(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """``sized`` with its plan, its place ``v`` in the ranking (null if nothing
    of it is sampled) and the bucket of that."""
    plan = plan.withColumnRenamed("source", "_s").withColumnRenamed("grade", "_g")
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("_s")) & (grade(F.col("size")) == F.col("_g")), "left")
    above, below = F.col("u") * (1 - F.col("p")), (1 - F.col("u")) * F.col("p")
    return (out.drop("_s", "_g").withColumn("v", F.when(F.col("p") > 0, above / (above + below)))
            .withColumn("bucket", F.floor(F.col("v") * F.col("buckets")).cast("long")))


def _fill(cut: DataFrame, gap: str, out: str) -> DataFrame:
    """One pass over the ranked units of each cut bucket that still fit: take
    them in order while more than ``near`` words are missing."""
    fits = (F.col("extra") == 0) & (F.col("words") <= F.col(gap))
    ranked = (W.partitionBy("source").orderBy((~fits).cast("int"), "v", "id", "size")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    cut = cut.withColumn("_sum", F.sum(F.when(fits, F.col("words")).otherwise(0)).over(ranked))
    cut = cut.withColumn("extra", F.when(
        fits & (F.col("_sum") <= F.col(gap)) & (F.col(gap) - F.col("_sum") + F.col("words") > F.col("near")), 1).otherwise(F.col("extra")))
    took = F.sum(F.when(F.col("extra") == 1, F.col("words")).otherwise(0)).over(W.partitionBy("source"))
    return cut.withColumn(out, F.col("gap") - took).drop("_sum")


def sampled_copies(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sized`` (source, id, size, u and any more) with ``source_size``,
    ``target`` and ``copies``."""
    plan = small_side(_with_plan(source_targets(sized, weights, max_repeats), max_repeats), SMALL_ROWS)
    planned = _ranked(sized.select("source", "id", "size", "u"), plan).where(F.col("v").isNotNull())
    sums = planned.groupBy("source", "target", "rest", "bucket").agg(F.sum("size").alias("words"))
    up_to = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.withColumn("upto", F.sum("words").over(up_to)).where(F.col("upto") > F.col("rest"))
    cuts = small_side(
        sums.groupBy(F.col("source").alias("_c")).agg(
            F.min("bucket").alias("cut"), (F.min("target") * NEAR).alias("near"), F.min_by(F.col("rest") - F.col("upto") + F.col("words"), "bucket").alias("gap")),
        SMALL_ROWS)

    # rank the one bucket of each source in which its target falls
    cut = (planned.join(cuts, F.col("source").eqNullSafe(F.col("_c")) & (F.col("bucket") == F.col("cut")))
           .groupBy("source", "gap", "near", "id", "size", "v").agg((F.count(F.lit(1)) * F.col("size")).alias("words"))
           .withColumn("extra", F.lit(0)))
    # the front of the ranking, up to the first document that does not fit ...
    ranked = (W.partitionBy("source").orderBy("v", "id", "size")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    cut = cut.withColumn("extra", F.when(F.sum("words").over(ranked) <= F.col("gap"), 1).otherwise(0))
    took = F.sum(F.when(F.col("extra") == 1, F.col("words")).otherwise(0)).over(W.partitionBy("source"))
    cut = cut.withColumn("gap0", F.col("gap") - took)
    # ... then, twice and if too much is left, the next ones that fit into that
    cut = _fill(_fill(cut, "gap0", "gap1"), "gap1", "gap2")
    # and the smallest of the others if that comes nearer to the target
    least = W.partitionBy("source").orderBy("extra", "words", "v", "id")
    last = ((F.row_number().over(least) == 1) & (F.col("extra") == 0) & (F.col("gap2") > F.col("near"))
            & (F.col("words") - F.col("gap2") < F.col("gap2")))
    chosen = (cut.withColumn("extra", F.when(last, 1).otherwise(F.col("extra")))
              .where(F.col("extra") == 1)
              .select(F.col("source").alias("_xs"), F.col("id").alias("_xi"), F.col("size").alias("_xn"), "extra"))

    out = (_ranked(sized, plan)
           .join(cuts.drop("gap", "near"), F.col("source").eqNullSafe(F.col("_c")), "left").drop("_c")
           .join(small_side(chosen, SMALL_ROWS),
                 (F.col("bucket") == F.col("cut")) & F.col("source").eqNullSafe(F.col("_xs"))
                 & F.col("id").eqNullSafe(F.col("_xi")) & (F.col("size") == F.col("_xn")), "left"))
    sampled = (F.col("cut").isNull() & F.col("v").isNotNull() & (F.col("rest") > 0)) | (F.col("bucket") < F.col("cut")) | (F.col("extra") == 1)
    copies = F.least(F.col("whole") + F.when(F.coalesce(sampled, F.lit(False)), 1).otherwise(0), F.lit(max_repeats))
    return out.withColumn("copies", copies.cast("int")).drop(
        "whole", "p", "rest", "buckets", "v", "bucket", "cut", "extra", "_xs", "_xi", "_xn")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, *keep) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size"), unit_random(F.col(id_col), seed).alias("u"), *keep)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix as decisions, one row per document row: id, ``source``,
    ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    out = sampled_copies(_sized(docs, id_col, text_col, source_col, seed), weights, max_repeats)
    return out.select(F.col("id").alias(id_col), F.col("source"), "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def take_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the
    columns of ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = sampled_copies(_sized(docs, id_col, text_col, source_col, seed, row), weights, max_repeats)
    return (out.where(F.col("copies") > 0)
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select("row.*"))
