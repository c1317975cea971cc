"""Token counts of a unigram tokenizer by dynamic programming over a trie.

A unigram tokenizer splits a pre-token into the pieces with the highest sum of
scores.  The best score of a prefix depends on the prefix alone, so distinct
pre-tokens are inserted into a trie whose nodes hold the forward score and the
number of pieces of their prefix: a prefix that many pre-tokens share is
scored once, and the node a pre-token ends in holds its count.

Vocabulary: the pieces of a public vocabulary file, in their order.  No
tokenizer is trained: the score of a piece follows from its rank alone, by the
Zipf-Mandelbrot law log p = -log(rank + 2.7), and a character outside the
vocabulary counts as its UTF-8 bytes, each with the score of the last rank.
Ties between splits go to the one with fewer pieces.

A pre-token is a maximal run of characters other than white space, with a word
mark in place of a space before it and at the start of the text; every other
white-space character is a pre-token of its own.

Scale: nothing is shuffled.  Each task gathers the distinct pre-tokens of some
documents that it has not met yet, builds their trie, and keeps the counts of
at most ``max_words`` pre-tokens for what follows.  A pre-token longer than
``max_insert`` characters is scored by itself.

Defined results: null text and empty text have no tokens; repeated rows,
null ids and ties are counted row by row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The mark that the vocabulary's pieces use for the start of a word.
MARK = "▁"
ZIPF_SHIFT = 2.7
MAX_WORDS = 400_000
MAX_INSERT = 128
TRIE_WORDS = 20_000
SLICE = 200
_PRE = re.compile(r"(?: |^)?\S+|\s")


@lru_cache(maxsize=2)
def unigram_scores(model_path: str | None = None) -> tuple[dict[str, float], float, int]:
    """Scores of the pieces, the score of a byte, and the longest piece."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path or public_tokenizers.path("piece_bpe_32k.model"))
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    scores = {p: -math.log(rank + ZIPF_SHIFT) for rank, p in enumerate(pieces, 1)}
    return scores, -math.log(len(pieces) + ZIPF_SHIFT), max(map(len, scores))


class Vocabulary:
    """Scores of pieces by a rolling hash of their characters."""

    PRIME = 0x9E3779B97F4A7C15
    SLOTS = 22

    def __init__(self, scores: dict[str, float], byte_score: float, longest: int):
        self.scores, self.byte_score, self.longest = scores, byte_score, longest
        hashes = np.array([self.hash_of(p) for p in scores], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], np.array(list(scores.values()))[order]
        self.maybe = np.zeros(1 << self.SLOTS, bool)  # most lookups end here
        self.maybe[hashes >> np.uint64(64 - self.SLOTS)] = True
        self.powers = np.array([pow(self.PRIME, k, 1 << 64) for k in range(longest + 1)], np.uint64)

    def hash_of(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * self.PRIME + ord(c) + 1) & ((1 << 64) - 1)
        return h

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are pieces, and their scores."""
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - self.SLOTS)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        return some[hit], self.values[at[hit]]


def trie_counts(words: list[str], vocabulary: Vocabulary) -> tuple[list[int], int]:
    """Token counts of distinct words, and how many trie nodes were scored.

    The words are sorted, so the words under a trie node are neighbours; node
    ``(i, d)`` is the prefix of length ``d`` of word ``i``, the first that has
    it.  Nodes are scored depth by depth, all nodes of a depth at once: the
    best split of a prefix ends in one of the pieces that are its suffixes, and
    goes on with the score of an ancestor.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    size = np.array([len(words[i]) for i in order])
    n, depth = len(order), int(size.max())
    flat = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.arange(depth) < size[:, None]
    chars = np.zeros((n, depth), np.uint32)
    chars[inside] = flat
    same = np.zeros((n, depth), bool)  # the prefix up to here is that of the word before
    same[1:] = np.logical_and.accumulate((chars[1:] == chars[:-1]) & inside[1:] & inside[:-1], axis=1)
    new = inside & ~same
    owner = np.zeros((n, depth + 1), np.int32)
    owner[:, 1:] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32)[:, None], 0), axis=0)
    bytes_of = 1 + (chars > 0x7F) + (chars > 0x7FF) + (chars > 0xFFFF)
    rolled = np.zeros((n, depth + 1), np.uint64)
    for d in range(depth):
        rolled[:, d + 1] = rolled[:, d] * np.uint64(vocabulary.PRIME) + chars[:, d] + np.uint64(1)
    score, count = np.zeros((n, depth + 1)), np.zeros((n, depth + 1), np.int32)
    for d in range(1, depth + 1):
        rows = np.flatnonzero(new[:, d - 1])
        if not len(rows):
            continue
        up, b = owner[rows, d - 1], bytes_of[rows, d - 1]
        best, pieces = score[up, d - 1] + b * vocabulary.byte_score, count[up, d - 1] + b
        here = rolled[rows, d]
        for k in range(1, min(d, vocabulary.longest) + 1):
            hit, value = vocabulary.find(here - rolled[rows, d - k] * vocabulary.powers[k])
            if len(hit):
                up = owner[rows[hit], d - k]
                value = value + score[up, d - k]
                fewer = count[up, d - k] + 1
                better = (value > best[hit]) | ((value == best[hit]) & (fewer < pieces[hit]))
                hit = hit[better]
                best[hit], pieces[hit] = value[better], fewer[better]
        score[rows, d], count[rows, d] = best, pieces
    out = [0] * n
    for i, c in zip(order, count[owner[np.arange(n), size], size].tolist()):
        out[i] = c
    return out, int(new.sum())


def long_count(word: str, vocabulary: Vocabulary) -> int:
    """The same recurrence for one long pre-token, over a sliding window."""
    best, base, longest = [(0.0, 0)], 0, vocabulary.longest
    get = vocabulary.scores.get
    for end in range(1, len(word) + 1):
        score, minus = best[-1]
        n = len(word[end - 1].encode("utf-8", "surrogatepass"))
        found = (score + n * vocabulary.byte_score, minus - n)
        for start in range(max(0, end - longest), end):
            piece = get(word[start:end])
            if piece is not None:
                score, minus = best[start - base]
                if (score + piece, minus - 1) > found:
                    found = (score + piece, minus - 1)
        best.append(found)
        if len(best) > 4 * longest:
            base += len(best) - longest - 1
            del best[:len(best) - longest - 1]
    return -best[-1][1]


class Counts(dict):
    """Counts by pre-token, of at most about ``max_words`` of them."""

    def __init__(self, vocabulary: Vocabulary, max_words: int = MAX_WORDS, max_insert: int = MAX_INSERT):
        self.vocabulary, self.max_words, self.max_insert = vocabulary, max_words, max_insert
        self.nodes_scored = 0

    def learn(self, found: set[str]) -> None:
        if len(self) > self.max_words:
            self.clear()
        words = [w for w in found if w not in self]
        forms = [MARK + w[1:] if w[0] == " " else w for w in words]
        groups: dict[int, list[int]] = {}  # words of like length, as a trie is a table of its depth
        for i, form in enumerate(forms):
            if len(form) > self.max_insert:
                self[words[i]] = long_count(form, self.vocabulary)
            else:
                groups.setdefault(len(form) // 24, []).append(i)
        for group in groups.values():
            for k in range(0, len(group), TRIE_WORDS):
                part = group[k:k + TRIE_WORDS]
                counts, nodes = trie_counts([forms[i] for i in part], self.vocabulary)
                self.nodes_scored += nodes
                self.update(zip([words[i] for i in part], counts))


def pre_tokens(text: str) -> list[str]:
    found = _PRE.findall(text)
    if found and text[0] > " " and not text[0].isspace():
        found[0] = " " + found[0]
    return found


def count_texts(texts: list[str | None], counts: Counts) -> tuple[list[int], list[int]]:
    """Numbers of pre-tokens and of tokens of each text."""
    found = [pre_tokens(t) if t else [] for t in texts]
    counts.learn(set().union(*found))
    get = counts.__getitem__
    return [len(f) for f in found], [sum(map(get, f)) for f in found]


def _counter(model_path, max_words, max_insert, schema: pa.Schema):
    def count(batches):
        counts = Counts(Vocabulary(*unigram_scores(model_path)), max_words, max_insert)
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                part = batch.slice(k, SLICE)
                words, tokens = count_texts(part.column(1).to_pylist(), counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], schema=schema)
    return count


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None,
                 max_words: int = MAX_WORDS, max_insert: int = MAX_INSERT) -> DataFrame:
    """One row per document: id, ``n_pretokens``, ``n_tokens``."""
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([T.StructField(id_col, slim.schema[0].dataType),
                           T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    return slim.mapInArrow(_counter(model_path, max_words, max_insert, to_arrow_schema(schema)), schema)
