"""Fill-in-middle against plain slicing, the skip list against running sums."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickwave.llm import fill_in_middle as fim
from tests.llm.fixtures import awkward, documents

MARKED = [(700 + k, t, "a") for k, t in enumerate([
    "a <P> b", "tail <", "<S", "<<P", "P> <M", "\r\n", "\x00x", "é🙂🙂" * 30, "<S><", "ends with <P"])] * 2


def plain(doc_id, text):
    text = text or ""
    n, h = len(text), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("clashing", [False, True])
def test_every_text_is_cut_like_a_slice_and_can_be_restored(spark, clashing):
    many = [(10_000 + k, t, "a") for k in range(12) for _, t, _ in MARKED[:10]]
    rows = awkward() + MARKED + [(i + 100 * k, t, s) for k, (i, t, s) in enumerate(many)]
    got = fim.fill_in_middle_digests(documents(spark, rows, clashing)).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = Counter()
    for i, t, _ in rows:
        *columns, output = plain(i, t)
        want[(i, *columns, sha(output), sha(t))] += 1
    assert Counter(map(tuple, got)) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_the_skip_list_adds_up_to_the_offset():
    rng = random.Random(2)
    for n in [0, 1, 2, 7, 8, 9, 100, 5000]:
        widths = np.array([rng.randint(0, 9) for _ in range(n)], np.int64)
        units, sums = fim.SkipList(widths), np.cumsum(np.append(0, widths))
        for r in {0, n, *(rng.randint(0, n) for _ in range(50))}:
            assert units.offset(r) == sums[r]


def test_a_descent_takes_few_steps():
    lanes = fim.SkipList(np.ones(200_000, np.int64)).lanes
    assert len(lanes) >= 4 and len(lanes[-1][0]) < 200
    assert all(int(units.sum()) == int(points.sum()) == 200_000 for units, points, _ in lanes)


def test_words_as_units(spark):
    text = "one two  three\nfour"
    rows = [(k, text, "a") for k in range(60)]
    out = fim.fill_in_middle(documents(spark, rows), unit=r"\S+")
    starts = {0, 4, 9, 15, len(text)}
    for r in out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect():
        assert r.n == 4 and r.back == text
        assert r.form == "plain" or {r.prefix_chars, r.prefix_chars + r.middle_chars} <= starts


def test_an_empty_table(spark):
    assert fim.fill_in_middle_digests(documents(spark, [])).count() == 0
