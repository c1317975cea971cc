"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens (runs of word characters) are tagged toxic or other.  Weights belong to
features of a token: the lower-cased word and its prefixes of 3 to 6
characters, so that an unseen inflection of a known word is recognised.

Training needs labelled tokens, and the labels are of documents: a token of a
toxic document is labelled toxic when one of its features is found in more
toxic documents than chance explains, and in nearly no others (counted over
documents without near copies),
every token of the others is labelled other, and toxic documents that this
explains nowhere are left out.  The field is fitted to these labels by
gradient ascent on its conditional likelihood.  Rows to learn from: those with
a label whose crc32(id as text) mod 5 is not 0, at most ``max_toxic`` and
``max_other`` of them (those with the smallest hash of the id).

Scoring is exact forward-backward.  With two states, forward and backward
ratios are chains of fractional linear maps, so they are composed block by
block over all tokens of a batch; a document's start and end reset the chain.
A document's score is the probability that at least one of its offending
tokens (marginal of ``floor`` or more) is toxic; spans are runs of tokens with
a marginal of 0.5 or more, with their character offsets.

Scale: fitting reads a bounded sample, in one task, which keeps its tokens as
numbers (some 40 bytes each) and neither the texts nor their words; scoring reads every document once, in
whole, and shuffles nothing.  The model holds the features of the sample that
have a weight, some MB at most.

Defined results: null and empty texts score 0 and have no spans; without
toxic labels every score is 0; a null id is never held out nor learned from;
repeated rows score alike; of several texts of an id the one with the smallest
hash is learned from; repeated labels of an id count as toxic if one of them is; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_TOXIC, MAX_OTHER = 1000, 2000
LEAST_WEIGHT = 0.05
FLOOR = 0.05
CHANCE, RARE, IMPURE = 0.01, 0.005, 0.05
STEPS, RATE, DECAY = 50, 0.4, 1e-4
CACHED_WORDS = 100_000
_BLOCK = 64
_PIECE = 1024 * _BLOCK
_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """Features of a lower-cased word: itself and its prefixes."""
    return [word, *[word[:k] + "-" for k in (3, 4, 5, 6) if len(word) >= k]]


@dataclass
class Field:
    """Weights by feature, and scores of a start in the toxic state and of
    the moves other-toxic, toxic-other and toxic-toxic; all others are 0."""

    weights: dict[str, float]
    bias: float
    start: float
    move: np.ndarray



Maps = Callable[[int, int], list[np.ndarray]]


def _columns(m: list[np.ndarray]) -> list[np.ndarray]:
    """The maps ``m`` with a column for each block; the last one is filled with identities."""
    blocks = -(-len(m[0]) // _BLOCK)
    fill = blocks * _BLOCK - len(m[0])
    return [np.ascontiguousarray(np.concatenate((x, np.full(fill, one))).reshape(blocks, _BLOCK).T)
            for x, one in zip(m, (1.0, 0.0, 0.0, 1.0))]


def _scan(maps: Maps, n: int, r: float) -> np.ndarray:
    """x[t] = (a x[t-1] + b) / (c x[t-1] + d) for ``n`` tokens, from ``r``;
    ``maps(i, j)`` gives ``a, b, c, d`` of the tokens from i to j."""
    out = np.empty(n)
    if n <= _BLOCK:
        m = maps(0, n)
        for t in range(n):
            r = (m[0][t] * r + m[1][t]) / (m[2][t] * r + m[3][t])
            out[t] = r
        return out
    pieces = [(i, min(n, i + _PIECE)) for i in range(0, n, _PIECE)]
    over = []  # one map for each block
    for i, j in pieces:
        rows = _columns(maps(i, j))
        a, b, c, d = (x[0] for x in rows)
        for t in range(1, _BLOCK):
            e, f, g, h = (x[t] for x in rows)
            a, b, c, d = e * a + f * c, e * b + f * d, g * a + h * c, g * b + h * d
            top = np.maximum(np.maximum(a, b), np.maximum(c, d))
            a, b, c, d = a / top, b / top, c / top, d / top
        over.append((a, b, c, d))
    over = [np.concatenate(x) for x in zip(*over)]
    before = np.concatenate(([r], _scan(lambda i, j: [x[i:j] for x in over], len(over[0]), r)[:-1]))
    for i, j in pieces:
        rows = _columns(maps(i, j))
        x = before[i // _BLOCK:-(-j // _BLOCK)]
        part = np.empty((_BLOCK, len(x)))
        for t in range(_BLOCK):
            x = (rows[0][t] * x + rows[1][t]) / (rows[2][t] * x + rows[3][t])
            part[t] = x
        out[i:j] = part.T.reshape(-1)[:j - i]
    return out


def odds(emission: np.ndarray, first: np.ndarray, start: float, move: np.ndarray,
         token: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios of the toxic to the other state for tokens
    in a row; ``first`` marks the first token of each document.  With
    ``token``, ``emission`` belongs to the words that it gives by number."""
    e, n = np.exp(emission), len(first)
    ot, to, tt = np.exp(move)
    begin = np.exp(start)

    def of(i, j):
        return e[i:j] if token is None else e[token[i:j]]

    def ahead(i, j):
        new, x = first[i:j], of(i, j)
        return [np.where(new, 0.0, x * tt), np.where(new, x * begin, x * ot), np.where(new, 0.0, to), np.ones_like(x)]

    def back(i, j):  # counted from the last token
        i, j = n - j, n - i
        last, after = first[i + 1:j + 1], of(i + 1, j + 1)
        if j == n:
            last, after = np.append(last, True), np.append(after, 1.0)
        return [x[::-1] for x in (np.where(last, 0.0, after * tt), np.where(last, 1.0, to),
                                  np.where(last, 0.0, after * ot), np.ones_like(after))]
    return _scan(ahead, n, 1.0), _scan(back, n, 1.0)[::-1]


def _no_near_copies(docs: Iterable[tuple[list[str], bool]]) -> Iterator[tuple[list[str], bool]]:
    """The labelled documents without those that have no words or share a
    min-hash of their word triples with an earlier one."""
    seen = set()
    for words, y in docs:
        if not words:
            continue
        n = max(1, len(words) - 2)
        hashes = np.fromiter((crc32(" ".join(words[k:k + 3]).encode("utf-8", "surrogatepass")) for k in range(n)),
                             np.uint64, n)
        marks = {(k, int(((hashes * np.uint64(2 * k + 0x9E3779B1)) & np.uint64(0xFFFFFFFF)).min())) for k in range(6)}
        if not marks & seen:
            yield words, y
        seen |= marks


def _telling(toxic: list[np.ndarray], other: np.ndarray, n_other: int, tried: int) -> np.ndarray:
    """Which features tell toxic documents (given as their features) from
    others (given as the number of documents with each feature).

    A feature tells if chance would not give any of ``tried`` features so many
    toxic documents (a binomial bound, at a level of ``CHANCE``) and nearly no
    other document has it.  Once more for the documents that no such feature
    explains, until nothing is added.
    """
    telling = np.zeros(len(other), bool)
    left, goal = toxic, np.log(max(tried, 2) / CHANCE)
    while left:
        has = np.bincount(np.concatenate(left), minlength=len(other)).astype(float)
        share, n = len(left) / (len(left) + n_other), has + other
        q = np.clip(has / np.maximum(n, 1), 1e-12, 1 - 1e-12)
        surprise = n * (q * np.log(q / share) + (1 - q) * np.log((1 - q) / (1 - share)))
        fits = (q > share) & (other <= RARE * n_other) & (q >= 1 - IMPURE)
        new = fits & (surprise >= goal)
        if not new.any() and not telling.any() and fits.any():  # few labels: the best there is
            new = fits & (surprise >= surprise[fits].max() - 1e-9)
        if not (new & ~telling).any():
            return telling
        telling |= new
        left = [f for f in left if not telling[f].any()]
    return telling


def _expected(word: np.ndarray, token: np.ndarray, first: np.ndarray, start: float,
              move: np.ndarray) -> tuple[np.ndarray, float, list[float]]:
    """Expected numbers of toxic tokens, by word, and of toxic first tokens,
    and of the moves other-toxic, toxic-other and toxic-toxic."""
    forward, backward = odds(word, first, start, move, token)
    by_word, firsts = np.zeros(len(word)), []
    for i in range(0, len(token), _PIECE):
        p = forward[i:i + _PIECE] * backward[i:i + _PIECE]
        p = p / (1 + p)
        np.add.at(by_word, token[i:i + _PIECE], p)
        firsts.append(p[first[i:i + _PIECE]])
    e, inner = np.exp(word), ~first[1:]
    ot, to, tt = np.exp(move)
    shares = np.empty(len(inner)), forward[:-1], backward[1:]  # the odds are used up, piece by piece
    for i in range(0, len(inner), _PIECE):
        j = min(len(inner), i + _PIECE)
        # pairs: forward ratio before, move, emission, backward ratio after
        f, b = forward[i:j], e[token[i + 1:j + 1]] * backward[i + 1:j + 1]
        moves = ot * b, to * f, tt * f * b
        total = 1 + moves[0] + moves[1] + moves[2]
        for share, x in zip(shares, moves):
            share[i:j] = x / total
    pairs = [share[inner].sum() for share in shares]
    return by_word, np.concatenate(firsts).sum(), pairs


def fit(texts: Iterable[str | None], toxic: Iterable[bool], steps: int = STEPS) -> Field | None:
    """A field from labelled documents; None if nothing can be learned."""
    return fit_rows(zip(texts, toxic), steps)


def fit_rows(rows: Iterable[tuple[str | None, bool]], steps: int = STEPS) -> Field | None:
    """:func:`fit` from pairs of text and label.  They are read one by one and
    kept as numbers of words; beside these a step holds three or four numbers a token."""
    words: dict[str, int] = {}
    ids, label = [], []
    for doc, y in _no_near_copies(([w.lower() for w in _WORD.findall(t or "")], bool(y)) for t, y in rows):
        ids.append(np.fromiter((words.setdefault(w, len(words)) for w in doc), np.int32, len(doc)))
        label.append(y)
    label = np.array(label, bool)
    if not label.any() or label.all():
        return None
    names: dict[str, int] = {}
    flat = np.fromiter((names.setdefault(f, len(names)) for w in words for f in features(w)), np.int64)
    many = np.fromiter((len(features(w)) for w in words), np.int64, len(words))
    n_words = len(words)
    del words
    of = np.repeat(np.arange(n_words), many)
    n = len(names)
    found = np.zeros((2, n))  # documents with a feature: other, toxic
    starts = np.searchsorted(of, np.arange(n_words + 1))
    for d, y in zip(ids, label):
        found[int(y), np.unique(np.concatenate([flat[starts[w]:starts[w + 1]] for w in np.unique(d)]))] += 1
    telling = _telling([np.unique(np.concatenate([flat[starts[w]:starts[w + 1]] for w in np.unique(d)]))
                        for d, y in zip(ids, label) if y], found[0], int((~label).sum()), n)
    marked = np.zeros(n_words, bool)
    np.logical_or.at(marked, of, telling[flat])
    use = [i for i in range(len(ids)) if not label[i] or marked[ids[i]].any()]
    if not any(label[i] for i in use):
        return None
    gold = np.concatenate([marked[ids[i]] & label[i] for i in use])
    first = np.zeros(len(gold), bool)
    first[np.cumsum([0, *(len(ids[i]) for i in use)])[:-1]] = True
    token = np.concatenate([ids[i] for i in use])
    del ids

    # ascent on the mean log-likelihood, with steps scaled by past gradients
    theta = np.zeros(n + 5)
    theta[n] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = ~first
    pair = lambda a, b: np.array([np.sum(~a[:-1] & b[1:] & inner[1:]), np.sum(a[:-1] & ~b[1:] & inner[1:]),
                                  np.sum(a[:-1] & b[1:] & inner[1:])], float)
    gold_pairs, gold_first = pair(gold, gold), gold[first].sum()
    gold_token = np.bincount(token[gold], minlength=n_words).astype(float)
    for step in range(1, steps + 1):
        word = np.clip(theta[n] + np.bincount(of, theta[flat], n_words), -30, 30)
        p_word, p_first, pairs = _expected(word, token, first, theta[n + 1], theta[n + 2:])
        by_word = gold_token - p_word
        grad = np.concatenate((np.bincount(flat, by_word[of], n), [by_word.sum(), gold_first - p_first],
                               gold_pairs - pairs)) / len(use) - DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    weights = {f: float(theta[i]) for f, i in names.items() if abs(theta[i]) >= LEAST_WEIGHT}
    return Field(weights, float(theta[n]), float(theta[n + 1]), theta[n + 2:].copy())


class _Emissions(dict):
    """Emission scores by word, for one worker."""

    def __init__(self, field: Field | None):
        self.weights, self.bias = (field.weights, field.bias) if field else ({}, 0.0)

    def __missing__(self, word: str) -> float:
        if len(self) > CACHED_WORDS:
            self.clear()
        get = self.weights.get
        e = self[word] = min(30.0, max(-30.0, self.bias + sum([get(f, 0.0) for f in features(word.lower())])))
        return e


def tag(texts: list[str | None], field: Field | None, cache: _Emissions | None = None,
        floor: float = FLOOR) -> list[tuple[float, list[tuple[int, int, float]]]]:
    """Score and spans (start, end, mean marginal) of each text."""
    out: list = [(0.0, [])] * len(texts)
    if field is None:
        return out
    get = (cache if cache is not None else _Emissions(field)).__getitem__
    found = [_WORD.findall(t) if t else [] for t in texts]
    some = [i for i, words in enumerate(found) if words]
    if not some:
        return out
    sizes = np.array([len(found[i]) for i in some])
    at = np.cumsum(sizes) - sizes
    emission = np.fromiter((e for i in some for e in map(get, found[i])), float, int(sizes.sum()))
    first = np.zeros(len(emission), bool)
    first[at] = True
    forward, backward = odds(emission, first, field.start, field.move)
    p = forward * backward
    p = np.minimum(p / (1 + p), 1 - 1e-9)
    score = 1 - np.exp(np.add.reduceat(np.where(p >= floor, np.log1p(-p), 0.0), at))
    score = np.maximum(score, np.maximum.reduceat(p, at))
    for k, i in enumerate(some):
        spans = []
        mine = p[at[k]:at[k] + sizes[k]]
        if score[k] >= 0.5 and (mine >= 0.5).any():
            run = None
            for x, w in zip(mine, _WORD.finditer(texts[i])):
                if x < 0.5:
                    run = None
                elif run is None:
                    run = [w.start(), w.end(), [float(x)]]
                    spans.append(run)
                else:
                    run[1] = w.end()
                    run[2].append(float(x))
            spans = [(a, b, sum(c) / len(c)) for a, b, c in spans]
        out[i] = (float(score[k]), spans)
    return out


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_other: int = MAX_OTHER) -> Field | None:
    """Fit a field to a bounded sample of the labelled rows that are not held out."""
    per = (labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y"))
           .where(F.col("i").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("i")))
           .groupBy("i").agg(F.max(F.col("y").cast("int")).alias("y")))
    order = F.xxhash64(F.col("i").cast("string"))
    rows = [r for y, n in ((1, max_toxic), (0, max_other))
            for r in per.where(F.col("y") == y).orderBy(order, "i").limit(n).collect()]
    if not rows:
        return None
    ids = F.broadcast(docs.sparkSession.createDataFrame(rows, per.schema))  # at most max_toxic + max_other rows
    texts = (docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t"))
             .join(ids, "i").groupBy("i", "y").agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t"))
             .select(order.alias("k"), F.col("i").cast("string"), "t", "y"))

    def learn(batches):  # the bounded sample, in one task; the driver gets the weights alone
        field = fit_rows((t.as_py(), y.as_py() == 1) for b in batches for t, y in zip(*b.columns))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(field)])], names=["field"])
    in_order = texts.coalesce(1).sortWithinPartitions("k", "i").select("t", "y")
    learned = in_order.mapInArrow(learn, "field binary").first()
    return pickle.loads(bytes(learned[0])) if learned else None


def score_documents(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text",
                    floor: float = FLOOR) -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted`` and
    the offending ``spans`` (start, end, score) of the documents predicted toxic."""
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    scored = T.StructType([slim.schema[0], *_SCORED.fields])
    out = slim.mapInArrow(_scorer(field, floor, scored), scored)
    return out.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                      T.StructField("score", T.DoubleType())])
_SCORED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(_SPAN))])


def _scorer(field, floor, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        cache = _Emissions(field)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                tagged = tag(part.column(1).to_pylist(), field, cache, floor)
                spans = [[{"start": a, "end": b, "score": c} for a, b, c in s] for _, s in tagged]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x for x, _ in tagged], pa.float64()),
                     pa.array(spans, arrow.field("spans").type)], schema=arrow)
    return run


def without_toxic(docs: DataFrame, field: Field | None, text_col: str = "text", floor: float = FLOOR) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, in whole."""
    if field is None:
        return docs
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches):
        cache = _Emissions(field)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                tagged = tag([None if x is None else str(x) for x in part.column(at).to_pylist()], field, cache, floor)
                yield part.filter(pa.array([x < 0.5 for x, _ in tagged], pa.bool_()))
    return docs.mapInArrow(run, schema)
