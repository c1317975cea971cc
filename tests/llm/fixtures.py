"""Small tables with every awkward case, and helpers to read results."""

import random

from pyspark.sql import types as T

#: Columns that clash with names the operators use inside.
CLASHING = ["id", "size", "u", "row", "rep", "fp", "key", "band", "sig", "c", "pos", "score", "copies", "extra", "gap",
            "copy", "wrapper", "host", "h", "v", "n", "members", "component", "node", "spans", "kept", "drop", "text_"]

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def documents(spark, rows, clashing=False):
    """``rows``: (doc_id, text, source)."""
    df = spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], DOCUMENTS)
    return with_clashing(df) if clashing else df


def with_clashing(df):
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit("x") for c in CLASHING if c not in df.columns})


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(n))


def awkward(seed: int = 5):
    """Nulls, empty and very long texts, repeated rows, ties and odd characters."""
    rng = random.Random(seed)
    rows = [(1, None, "a"), (2, "", "a"), (3, "   \n\t ", None), (4, prose(rng, 6000), "b"), (5, "x" * 50_000, "b"),
            (None, "no id here at all", "a"), (6, "eins zwei  drei vier\n\nfünf 漢字 🙂 <|endoftext|>", None),
            (7, "same text for both of us", "a"), (8, "same text for both of us", "b"), (9, "a", "c"), (9, "a", "c")]
    return rows + [(100 + k, prose(rng, rng.randint(1, 400)), rng.choice("abc")) for k in range(60)]
