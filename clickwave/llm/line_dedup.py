"""Recurring lines by a log-template tree, in DataFrame functions only.

Lines are parsed by a tree of fixed depth: tokens that hold a digit become a
wildcard, the first level is the number of tokens, the next ones the leading
``depth`` tokens.  In every leaf, lines gather around leaders; a leader is the
template of its family, and the positions at which its lines differ from it are
the template's variable fields.  A line may differ from its leader in less than
``1 - similar`` of the positions after the leading ones; these are cut into one
part more than may differ, so the two must have a part in common.  The line
with most texts (ties: largest hash) leads all lines that share a part with it;
a line's leader is the one with most texts (ties: largest hash) among the
leaders of its parts that agree with it, or the line itself.

A template that occurs in at least ``min_docs`` different texts is recurring,
and so is a line of ``long_tokens`` or more tokens that occurs as it is (masked,
unless most of its tokens are variable) in ``long_docs``: its lines are dropped from all texts but one, that of its smallest
document id (and texts equal to it).  A line of at most ``depth`` tokens is its leaf's only
line and so its own template.  In such a line, scripts written without spaces
have only their digits masked, as a token may be a whole paragraph, and a line
of nothing but variable tokens stands for itself.
Equal texts count as one text, so copies of a document do not make its lines
recur; near copies are the business of near-duplicate removal, but the long
lines that they share, and others that ``min_docs`` of them share, are dropped here.

Scale: leaves are counted by hashes of lines; only lines in leaves with enough
texts (here a tenth of all) are compared, each with the leaders of its parts,
in one pass whatever the data.  Leaders, families and leaves are found by
map-side aggregation, and what is joined by a part, a leader or a template is
read back from the shared folder, so that Spark splits hot ones; lines to drop
are gathered per text, and documents are shuffled once, by a hash of their
text, to join them.  No group is collected: a leaf, a template or a text that
holds a third of all rows is only counted.

Defined results: null text stays null, empty text stays empty; a text whose
lines are all dropped becomes empty; repeated rows lose the same lines; rows
without an id count, and keep a template only if no row with an id has it;
an empty table gives no rows;
extra columns are kept by :func:`without_recurring_lines`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwave.llm.common import small_side
from clickwave.session import checkpoint_dir

DEPTH, MIN_DOCS = 3, 5
LONG_TOKENS, LONG_DOCS = 50, 2
SIMILAR = 0.7
SMALL_LEAVES = 100_000
WILD = "<*>"
#: A token with a digit, found only from the start of a token on.
_VARIABLE = r"(?<!\S)[^\s0-9]*+[0-9]\S*"
_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def masked(line: Column, depth: int) -> Column:
    """``line``, its white space reduced, with its variable tokens as wildcards."""
    short = F.when(line.rlike(_UNSPACED), F.regexp_replace(line, "[0-9]+", WILD)).otherwise(F.regexp_replace(line, _VARIABLE, WILD))
    return (F.when(~line.rlike("[0-9]"), line)
            .when(F.size(F.split(line, " ", -1)) > depth, F.regexp_replace(line, _VARIABLE, WILD))
            .when(short.rlike("[^<*> ]"), short).otherwise(line))


def _spaced(raw: Column) -> Column:
    """``raw`` with its white space reduced; most lines have single spaces only."""
    odd = raw.contains("  ")
    for c in "\t\x0b\f\r":
        odd = odd | raw.contains(c)
    return F.trim(F.when(odd, F.regexp_replace(raw, r"\s+", " ")).otherwise(raw))


def lines_by_leaf(texts: DataFrame, depth: int) -> DataFrame:
    """``id, c, size, pos, raw, n, leaf`` of every line that is not blank:
    ``raw`` is the line as it is, its white space reduced, ``n`` its tokens.

    The leading tokens alone tell the leaf of a line of more than ``depth``
    tokens, so the whole line is masked only where its leaf matters."""
    raw, n = F.col("raw"), F.col("n")
    lead = F.when(n > depth, F.substring_index("raw", " ", depth)).otherwise(raw)
    lead = F.when(~lead.rlike("[0-9]"), lead).when(n > depth, F.regexp_replace(lead, _VARIABLE, WILD)).otherwise(masked(raw, depth))
    return (texts.select("id", "c", "size", F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
            .withColumn("raw", _spaced(raw)).where(raw != "")
            .withColumn("n", F.octet_length("raw") - F.octet_length(F.replace(raw, F.lit(" "), F.lit(""))) + 1)
            .withColumn("leaf", F.xxhash64(F.slice(F.split(lead, " ", -1), 1, depth))))


def parsed_lines(lines: DataFrame, depth: int, long_tokens: int) -> DataFrame:
    """``lines_by_leaf`` with ``line`` and ``f`` for ``raw``: ``line`` is masked,
    ``f`` its hash (or that of the line as it is, if it is long and most of its
    tokens are variable)."""
    lines = lines.withColumn("line", masked(F.col("raw"), depth)).withColumn("tokens", F.split("line", " ", -1))
    loose = (F.col("n") >= long_tokens) & (2 * F.size(F.filter("tokens", lambda x: x == WILD)) > F.col("n"))
    return lines.withColumn("f", _order_hash(F.when(loose, F.col("raw")).otherwise(F.col("line")))).drop("raw", "tokens")


def _order_hash(line: Column) -> Column:
    """60 bits of the MD5, which other systems have as well."""
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def _agreement(line: str, template: str, depth: int) -> Column:
    """Positions after the leading ones at which line and template agree."""
    free = lambda c: F.slice(F.split(c, " ", -1), depth + 1, F.size(F.split(c, " ", -1)))
    same = F.zip_with(free(line), free(template), lambda a, b: F.when(a == b, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda acc, x: acc + x)


def _families(lines: DataFrame, depth: int, similar: float) -> DataFrame:
    """``leaf, n, f, kind``: every line with its leader's hash."""
    line, part = ["leaf", "n", "f"], ["leaf", "n", "s", "key"]
    free = F.col("n") - depth
    least = F.ceil(F.round(free * F.lit(similar), 9)).cast("int")
    at = (lines.select(*line, "docs", "line", free.alias("m"), (free - least + 1).alias("parts"))
          .withColumn("s", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
          .withColumn("low", F.floor(F.col("s") * F.col("m") / F.col("parts")).cast("int"))
          .withColumn("high", F.floor((F.col("s") + 1) * F.col("m") / F.col("parts")).cast("int"))
          .select(*line, "docs", "s", F.xxhash64(F.slice(F.split("line", " ", -1), F.col("low") + depth + 1, F.col("high") - F.col("low"))).alias("key"))
          .checkpoint())
    leads = (at.groupBy(*part).agg(F.max(F.struct("docs", "f")).alias("top"), F.count(F.lit(1)).alias("_c"))
             .where(F.col("_c") > 1).drop("_c").checkpoint())
    meets = (at.join(leads, part).where(F.col("top.f") != F.col("f"))
             .groupBy(*line, F.col("top.f").alias("leader")).agg(F.max("top.docs").alias("rank")).checkpoint())
    templates = (lines.join(meets.select("leaf", "n", F.col("leader").alias("f")).distinct(), line)
                 .select("leaf", "n", F.col("f").alias("leader"), F.col("line").alias("template")).checkpoint())
    fits = (meets.join(templates, ["leaf", "n", "leader"]).join(lines.select(*line, "line"), line)
            .where(_agreement("line", "template", depth) >= least))
    best = fits.groupBy(*line).agg(F.max(F.struct("rank", "leader")).alias("best"))
    return lines.select(*line).join(best, line, "left").select(*line, F.coalesce("best.leader", "f").alias("kind"))


def recurring_lines(texts: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, similar: float = SIMILAR,
                    long_tokens: int = LONG_TOKENS, long_docs: int = LONG_DOCS) -> DataFrame:
    """``c, size, drop``: positions of the lines to drop from each text that
    loses any.  ``texts``: ``id, text`` and the text's hash and length ``c, size``."""
    checkpoint_dir(texts.sparkSession)
    every = lines_by_leaf(texts, depth)
    needed = lambda n: F.when(F.col(n) >= long_tokens, min(long_docs, min_docs)).otherwise(min_docs)
    leaves = (every.select("leaf", "n", "c").distinct().groupBy(F.col("leaf").alias("_l"), F.col("n").alias("_n"))
              .agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= needed("_n"))
              .select("_l", "_n", (F.col("texts") >= min_docs).alias("many")))
    found = every.join(small_side(leaves, SMALL_LEAVES), (F.col("leaf") == F.col("_l")) & (F.col("n") == F.col("_n")))
    found = parsed_lines(found.drop("_l", "_n"), depth, long_tokens).checkpoint()
    seen = found.select("leaf", "n", "f", "c", "size", "id", "pos")
    lines = (found.groupBy("leaf", "n", "f", "c").agg(F.first("line").alias("line"), F.first("many").alias("many"))
             .groupBy("leaf", "n", "f").agg(F.first("line").alias("line"), F.first("many").alias("many"), F.count(F.lit(1)).alias("docs"))
             .checkpoint())
    kinds = (_families(lines.where("many").where(F.col("n") > depth).drop("many"), depth, similar)
             .withColumn("needed", F.lit(min_docs)))
    # a line of its own kind, too, where that asks for fewer texts than its template
    apart = lines.where(~F.col("many") | (F.col("n") <= depth) | (F.col("n") >= long_tokens))
    own = (apart.where(F.col("docs") >= needed("n"))
           .select("leaf", "n", "f", F.col("f").alias("kind"), needed("n").alias("needed")))
    kinds = kinds.unionByName(own)

    occurs = seen.join(kinds, ["leaf", "n", "f"])
    per_text = occurs.groupBy("leaf", "n", "kind", "needed", "c", "size").agg(F.min("id").alias("id"))
    recurs = (per_text.groupBy("leaf", "n", "kind", "needed")
              .agg(F.count(F.lit(1)).alias("texts"), F.min(F.struct(F.col("id").isNull(), "id", "c", "size")).alias("first"))
              .where(F.col("texts") >= F.col("needed"))
              .select("leaf", "n", "kind", "needed", F.col("first.c").alias("_c"), F.col("first.size").alias("_size"))
              .checkpoint())  # read back, it joins by an exchange of its own, whose hot templates Spark splits
    return (occurs.join(recurs, ["leaf", "n", "kind", "needed"])
            .where((F.col("c") != F.col("_c")) | (F.col("size") != F.col("_size")))
            .groupBy("c", "size").agg(F.collect_set("pos").alias("drop")))


def _hashed(text: str) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("c"), F.length(text).alias("size")


def _cleaned(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """``row, text, kept, drop`` for each row of ``docs``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = F.col(text_col).cast("string").alias("text")
    drops = recurring_lines(docs.select(F.col(id_col).alias("id"), text).where(F.length("text") > 0)
                            .select("id", "text", *_hashed("text")), **options)
    rows = docs.select(row, text).withColumns({"_h": F.xxhash64("text"), "_m": F.length("text")})
    joined = rows.join(drops, (F.col("_h") == F.col("c")) & (F.col("_m") == F.col("size")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.when(F.col("drop").isNull(), F.col("text")).otherwise(
        F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("drop", i)), "\n"))
    return joined.select("row", "text", kept.alias("kept"), "drop")


def deduplicated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_dropped`` and the ``text`` that is left."""
    out = _cleaned(docs, id_col, text_col, **options)
    return out.select(F.col("row")[id_col].alias(id_col),
                      F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"), F.col("kept").alias("text"))


def without_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with the recurring lines dropped from its texts, and their
    lengths brought up to date; all rows and columns stay."""
    out = _cleaned(docs, id_col, text_col, **options)
    kinds = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("kept").alias(c)
        if c == length_col and c in kinds:
            return F.when(F.col("drop").isNull(), F.col("row")[c]).otherwise(F.length("kept")).cast(kinds[c]).alias(c)
        return F.col("row")[c].alias(c)
    return out.select(*[column(c) for c in docs.columns])
