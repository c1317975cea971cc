"""Near-duplicate documents and recurring lines against brute force."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from clickwave.llm import components, line_dedup, minhash_dedup
from clickwave.llm.catalog import ORACLES
from tests.llm.fixtures import awkward, documents, prose


def test_registers_agree_as_often_as_multisets_overlap():
    rng = np.random.default_rng(1)
    name = lambda k: minhash_dedup._mix(np.array([k + 1], np.uint64))[0]
    bag = lambda d: np.concatenate([np.full(n, name(k)) for k, n in d.items()])
    for spread in (0, 2, 6):
        a = {k: int(rng.integers(1, 9)) for k in range(40)}
        b = {k: max(1, n + int(rng.integers(-spread, spread + 1))) for k, n in list(a.items())[:35]} | {100 + k: 3 for k in range(4)}
        common = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b)
        truth = common / (sum(a.values()) + sum(b.values()) - common)
        sig = minhash_dedup.bag_minhash([bag(a), bag(b), np.empty(0, np.uint64)], 20_000)
        assert abs((sig[0] == sig[1]).mean() - truth) < 0.015 and minhash_dedup.overlap(bag(a), bag(b)) == truth
        assert not sig[2].any()


def test_signatures_do_not_depend_on_the_batch():
    rng, hashes = random.Random(8), minhash_dedup._Hashes()
    bags = [minhash_dedup.shingles(prose(rng, rng.randint(0, 60)).split(), hashes) for _ in range(200)]
    whole = minhash_dedup.bag_minhash(bags)
    assert all((minhash_dedup.bag_minhash(bags[k:k + n]) == whole[k:k + n]).all() for k, n in ((0, 1), (3, 2), (50, 100)))


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = prose(rng, 1)
    return " ".join(out)


def families(seed=2):
    """Families of edited copies around the threshold, repeated passages, awkward rows."""
    rng = random.Random(seed)
    rows = awkward()
    for k in range(25):
        words = prose(rng, rng.randint(20, 120)).split() * rng.choice((1, 1, 3))
        rows += [(1000 + 40 * k + j, edited(rng, words, rng.randint(0, len(words) // 25)), "a") for j in range(rng.randint(1, 12))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4, 500])
def test_components_match_all_pairs(spark, block):
    df = documents(spark, families(), clashing=True)
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(ORACLES["op6_minhash_dedup"]).fetchall()
    got = list(map(tuple, minhash_dedup.near_documents(df, block=block).collect()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_connected_copies_meet_outsiders_only(spark):
    """Rows sent for a bucket grow with the copies, and no pair of different
    components is left out."""
    outside = 6
    for copies, block in ((400, 20), (400, 500), (800, 20)):
        rows = [(0, 7, k, 0 if k < copies else k) for k in range(copies + outside)]
        near = spark.createDataFrame(rows, "band int, key long, rep long, comp long")
        got = minhash_dedup._cells_of_large_buckets(near, block).collect()
        cells = {}
        for r in got:
            cells.setdefault((r.i, r.j), []).append(r)
        met = {(a.rep, b.rep) for (i, j), rs in cells.items() for a in rs for b in rs
               if a.comp < b.comp and (i == j or a.block != b.block)}
        assert met == {(a.rep, b.rep) for a in map(_Row, rows) for b in map(_Row, rows) if a.comp < b.comp}
        assert len(got) <= 2 * copies + outside * (copies // block + 2)


class _Row:
    def __init__(self, row):
        _, _, self.rep, self.comp = row


def test_one_document_of_each_group_stays(spark):
    df = documents(spark, families(), clashing=True)
    decided = minhash_dedup.near_documents(df).collect()
    out = minhash_dedup.one_of_each_group(df)
    assert out.columns == df.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r.doc_id for r in decided if r.kept and r.doc_id is not None})
    assert ids.count(None) == 1


def test_an_id_with_several_texts_joins_them(spark):
    rng = random.Random(4)
    a, b = prose(rng, 50), prose(rng, 50)
    df = documents(spark, [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, b, "x"), (None, b, "x"), (None, "alone", "x")])
    got = {(r.doc_id, r.class_id, r.component_id, r.kept) for r in minhash_dedup.near_documents(df).collect()}
    assert got == {(1, 1, 1, True), (2, 1, 1, False), (2, 2, 1, False), (3, 2, 1, False), (None, 2, 1, False), (None, None, None, True)}


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert minhash_dedup.near_documents(empty).count() == 0
    assert minhash_dedup.one_of_each_group(empty).count() == 0
    assert line_dedup.deduplicated_lines(empty).count() == 0


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(n, n) == find(n) for n in root)


def template_lines(rows, depth=3, min_docs=5, similar=0.7, long_tokens=50, long_docs=2):
    """The tree over lists: positions of recurring lines by text."""
    import hashlib
    import math
    import re
    unspaced = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff]")
    lines = {}
    for i, text, _ in rows:
        for pos, raw in enumerate((text or "").split("\n") if text else []):
            raw = re.sub(r"[ \t\n\x0b\f\r]+", " ", raw).strip(" ")
            if not raw:
                continue
            wild = " ".join("<*>" if re.search("[0-9]", t) else t for t in raw.split(" "))
            if len(raw.split(" ")) <= depth:
                short = re.sub("[0-9]+", "<*>", raw) if unspaced.search(raw) else wild
                wild = short if re.search("[^<*> ]", short) else raw
            tokens = tuple(wild.split(" "))
            loose = len(tokens) >= long_tokens and 2 * tokens.count("<*>") > len(tokens)
            lines.setdefault((tokens, raw if loose else wild), []).append((i, text, pos))
    leaf = lambda t: (len(t[0]), t[0][:depth])
    size = lambda at: len({x for _, x, _ in at})
    texts = {}
    for t, at in lines.items():
        texts.setdefault(leaf(t), set()).update(x for _, x, _ in at)
    weight = {t: (size(at), int(hashlib.md5(t[1].encode()).hexdigest()[:15], 16)) for t, at in lines.items()}
    kinds, leads, parts = [], {}, {}
    for t in lines:
        n, free = len(t[0]), t[0][depth:]
        needed = min(long_docs, min_docs) if n >= long_tokens else min_docs
        many = len(texts[leaf(t)]) >= min_docs
        if (not many or n <= depth or n >= long_tokens) and weight[t][0] >= needed:
            kinds.append((t, ("own", t), needed))
        if many and n > depth:
            least = math.ceil(round(len(free) * similar, 9))
            k = len(free) - least + 1
            parts[t] = least, [(leaf(t), s, free[s * len(free) // k:(s + 1) * len(free) // k]) for s in range(k)]
            for p in parts[t][1]:
                leads[p] = max(leads.get(p, t), t, key=weight.get)
    for t, (least, keys) in parts.items():
        near = [x for x in {leads[p] for p in keys} - {t} if sum(a == b for a, b in zip(t[0][depth:], x[0][depth:])) >= least]
        kinds.append((t, ("family", max(near, key=weight.get, default=t)), min_docs))
    groups, drop = {}, {}
    for t, kind, needed in kinds:
        groups.setdefault((kind, needed), []).extend(lines[t])
    for (_, needed), at in groups.items():
        if size(at) >= needed:
            kept = min(at, key=lambda x: (x[0] is None, x[0]))[1]
            for _, text, pos in at:
                if text != kept:
                    drop.setdefault(text, set()).add(pos)
    return drop


def lined(seed=6):
    rng = random.Random(seed)
    rows = []
    for k in range(120):
        lines = [prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 5))]
        if k % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), f"Posted on day {k} by user{k} at noon")
        if k % 4 == 0:
            lines.append("All rights of this page  are reserved " + rng.choice(["here", "there", "now"]))
        if k % 30 == 0:
            lines.append("seen in four texts only, so it stays")
        rows.append((k, "\n".join(lines), "a"))
    same = "one text that has\nmany equal copies here\nand so its lines stay"
    return rows + [(500 + k, same, "b") for k in range(20)] + [(None, rows[0][1], "a"), (None, "Posted on day 3 by user9 at noon", "a")] + awkward()


def test_recurring_lines_match_the_tree_over_lists(spark):
    rows = lined()
    drop = template_lines(rows)
    got = line_dedup.deduplicated_lines(documents(spark, rows, clashing=True)).collect()
    want = []
    for i, text, _ in rows:
        lines = text.split("\n") if text is not None else []
        gone = drop.get(text, set())
        want.append((i, len(lines), len(gone), None if text is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(n for _, _, n, _ in want) > 50
    kept = [t for _, _, _, t in want if t]
    assert sum("Posted on day" in t for t in kept) == 2 and sum("All rights" in t for t in kept) == 2  # a text and its copy
    assert sum("equal copies" in t for t in kept) == 20 and sum("four texts" in t for t in kept) == 5


def kept_lines(spark, rows):
    """Texts that are left, as lists of lines, by id."""
    return {r.doc_id: r.text.split("\n") for r in line_dedup.deduplicated_lines(documents(spark, rows)).collect()}


def test_short_lines_recur_too(spark):
    rng = random.Random(12)
    lines = ["All rights reserved.", "Contact", "本站所有内容均受版权保护未经许可不得转载", "Page {} of", "目录 第{}页"]
    rows = [(k, "\n".join([prose(rng, 12), "", *(x.format(k) for x in lines), f"在{1990 + k}年" + "东西南北中发"[k], str(k), f"{k} {k}%"]), "a")
            for k in range(6)]
    rows += [(100 + k, prose(rng, 9) + "\nOnly four", "a") for k in range(4)]
    left = kept_lines(spark, rows)
    assert left[0] == rows[0][1].split("\n")  # the text with the smallest id keeps them
    for k in range(1, 6):
        own = rows[k][1].split("\n")
        assert left[k] == own[:2] + own[-3:]  # prose, blank line, a paragraph without spaces, numbers
    assert all(left[100 + k][1:] == ["Only four"] for k in range(4))


def test_long_lines_recur_in_two_texts(spark):
    rng = random.Random(13)
    long, crowded, shorter = "in this one " + prose(rng, 50), "one of many " + prose(rng, 57), prose(rng, 49)
    numbers = lambda k: " ".join(str(k * j) for j in range(60))
    rows = [(k, f"{prose(rng, 8)}\n{long} on {k} of May\n{shorter}\n{numbers(k)}", "a") for k in (1, 2)]
    # two of four texts of a template share a line: too few for the template, enough for the line
    family = [crowded, crowded] + [crowded.rsplit(" ", 4)[0] + " " + prose(rng, 4) for _ in range(2)]
    rows += [(10 + k, f"{prose(rng, 8)}\n{x}", "a") for k, x in enumerate(family)]
    rows += [(20 + k, f"{prose(rng, 8)}\none of many {prose(rng, 57)}", "a") for k in range(3)]  # the same leaf
    rows += [(30 + k, f"{prose(rng, 8)}\n{numbers(7)}", "a") for k in range(2)]
    left = kept_lines(spark, rows)
    dropped = {2: [1], 11: [1], 31: [1]}
    assert left == {i: [x for p, x in enumerate(t.split("\n")) if p not in dropped.get(i, [])] for i, t, _ in rows}


def test_families_of_a_mixed_leaf_are_all_found(spark):
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("klmnopqrst") for _ in range(6))
    rows = []
    for family in range(7):  # with the same length and first three tokens; two of ten words vary
        fixed = [word() for _ in range(8)]
        rows += [(10 * family + k, f"{prose(rng, 8)}\nthis is the {' '.join(fixed[:5])} {word()} {' '.join(fixed[5:])} {word()}", "a") for k in range(6)]
    rows += [(100 + k, "this is the " + " ".join(word() for _ in range(10)), "a") for k in range(40)]
    few = " ".join(word() for _ in range(9))
    rows += [(200 + k, f"this is the {few} {word()}", "a") for k in range(4)]
    left = kept_lines(spark, rows)
    assert sorted(i for i, x in left.items() if i < 100 and len(x) == 2) == [10 * k for k in range(7)]
    assert all(left[i] == t.split("\n") for i, t, _ in rows if i >= 100)


def test_stage_keeps_rows_and_columns(spark):
    df = documents(spark, lined(), clashing=True)
    out = line_dedup.without_recurring_lines(df)
    assert out.columns == df.columns and out.count() == df.count() and out.dtypes == df.dtypes
    assert all(r.n_chars == (len(r.text) if r.text is not None else None) for r in out.collect())


def test_no_python_on_the_main_path(spark):
    df = documents(spark, lined())
    plan = line_dedup.deduplicated_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapIn" not in plan
