"""The leaf of a line is found from its leading tokens, without masking the whole line."""

import random

from pyspark.sql import functions as F

from clickwave.llm import line_dedup


def test_the_leaf_of_a_line_is_that_of_its_masked_form(spark):
    rng = random.Random(5)
    bits = ["a", "b7", "7", "<*>", "naïve", "漢字3", "คำ", "x 5", "１", "\t", "  ", "\x0b", "\r", "\f ", "é9é"]
    lines = ["", " ", "\t", "5", "12 13", "漢9 8", "a\tb 5\r", "a b c d5 e6"]
    lines += [rng.choice([" ", "", "  "]).join(rng.choices(bits, k=rng.randrange(9))) for _ in range(600)]
    texts = spark.createDataFrame([(k, line, k, len(line)) for k, line in enumerate(lines)], "id long, text string, c long, size int")
    for depth in (1, 3):
        got = line_dedup.lines_by_leaf(texts, depth).select("id", "raw", "n", "leaf")
        raw = F.trim(F.regexp_replace("text", r"\s+", " "))
        tokens = F.split(line_dedup.masked(F.col("raw"), depth), " ", -1)
        want = (texts.select("id", raw.alias("raw")).where("raw <> ''")
                .select("id", "raw", F.size(tokens).alias("n"), F.xxhash64(F.slice(tokens, 1, depth)).alias("leaf")))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert want.count() > 400


def test_only_lines_of_leaves_that_count_are_masked(spark, monkeypatch):
    seen, parsed = [], line_dedup.parsed_lines

    def watched(lines, *args):
        seen.append(lines.count())
        return parsed(lines, *args)

    monkeypatch.setattr(line_dedup, "parsed_lines", watched)
    texts = [f"word{'x' * k} alone stands here {k}\nshared head of line {k}" for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = line_dedup.deduplicated_lines(docs).collect()
    assert sum(r.n_dropped for r in out) == 19 and seen == [20]
