"""Token counts, packing and id matrices against brute force and round trips."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickwave.llm import packing, token_counts, token_output
from tests.llm.fixtures import awkward, documents


def coder_ids(as_text):
    import public_tokenizers
    from tokenizers import Tokenizer
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = as_text
    return lambda text: coder.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference_ids():
    return coder_ids(False)


@pytest.fixture(scope="module")
def text_ids():
    """Ids with added tokens as ordinary text."""
    return coder_ids(True)


def test_added_tokens(reference_ids, text_ids):
    from clickwave.llm.tokenizer import byte_bpe
    mark, rng = "<|endoftext|>", random.Random(8)
    texts = ["hello <|endoftext|> world", mark, mark * 3, f"  {mark}  x", f"a{mark}\n\n{mark}  ", "<|endoftext|", f"<{mark}>"]
    texts += ["".join(rng.choice([mark, " ", "  ", "\n", "ab", "7", "é", "<|"]) for _ in range(12)) for _ in range(500)]
    assert reference_ids(texts[0]) == [31373, 220, 50256, 995]
    for t in texts:
        assert byte_bpe(added_tokens=True).encode(t).tolist() == reference_ids(t)
        assert byte_bpe().encode(t).tolist() == text_ids(t)


def best_split(word, scores, byte_score):
    """Count of the best split, by the plain recurrence over one word."""
    best = [(0.0, 0)]
    for i in range(1, len(word) + 1):
        n = len(word[i - 1].encode())
        options = [(best[i - 1][0] + n * byte_score, best[i - 1][1] - n)]
        options += [(best[j][0] + scores[word[j:i]], best[j][1] - 1) for j in range(max(0, i - 20), i) if word[j:i] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_match_the_plain_recurrence(spark):
    rows = awkward()
    scores, byte_score, _ = token_counts.unigram_scores()
    got = Counter(tuple(r) for r in token_counts.token_counts(documents(spark, rows, clashing=True)).collect())
    want = Counter()
    for i, text, _ in rows:
        words = token_counts.pre_tokens(text or "")
        want[i, len(words), sum(best_split(token_counts.MARK + w[1:] if w[0] == " " else w, scores, byte_score) for w in words)] += 1
    assert got == want


def test_a_shared_prefix_is_scored_once():
    vocabulary = token_counts.Vocabulary(*token_counts.unigram_scores())
    words = ["the", "then", "there", "other", "th", "zzz"]
    _, nodes = token_counts.trie_counts(words, vocabulary)
    assert nodes == len({w[:k] for w in words for k in range(1, len(w) + 1)})


def test_counts_do_not_depend_on_the_cache(spark):
    df = documents(spark, awkward())
    small = token_counts.token_counts(df, max_words=1, max_insert=3)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, token_counts.token_counts(df).collect()))


def subset_sums(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= room}
    return max(sums)


def test_best_fill_is_the_closest_subset_sum():
    rng = random.Random(3)
    for _ in range(200):
        counts = dict(Counter(rng.randint(1, 40) for _ in range(rng.randint(0, 12))))
        room = rng.randint(0, 100)
        used = packing.best_fill(counts, room)
        assert all(n <= counts[length] for length, n in used.items())
        assert sum(length * n for length, n in used.items()) == subset_sums(counts, room)


@pytest.mark.parametrize("buffer_pieces", [7, 20_000])
def test_packing_covers_every_id_once(spark, reference_ids, buffer_pieces):
    rows = awkward()
    pieces = packing.pack_documents(documents(spark, rows, clashing=True), buffer_pieces=buffer_pieces).collect()
    ids = {i: reference_ids(t) + [0] for i, t, _ in rows}
    times = Counter(i for i, _, _ in rows)
    covered, sequences = defaultdict(Counter), defaultdict(list)
    for p in pieces:
        part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4")
        assert 0 < p.length == len(part) and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(part.tobytes())
        covered[p.doc_id].update(range(p.start, p.start + p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    assert {i: dict(c) for i, c in covered.items()} == {i: dict.fromkeys(range(len(a)), times[i]) for i, a in ids.items()}
    short = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
        short += end < 1024 - packing.MAX_SLACK
    assert short <= documents(spark, rows).rdd.getNumPartitions()


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(documents(spark, [])).count() == 0
    assert token_output.packed_matrices(documents(spark, [])).count() == 0
    assert token_counts.token_counts(documents(spark, [])).count() == 0


def test_best_fit_takes_the_tightest_row():
    rng = random.Random(4)
    lengths = [rng.randint(1, 50) for _ in range(300)]
    rows, plain = token_output.best_fit(lengths, 50), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):  # the same rule by a linear search
        fits = [r for r in plain if sum(lengths[k] for k in r) + lengths[i] <= 50]
        if fits:
            max(fits, key=lambda r: sum(lengths[k] for k in r)).append(i)
        else:
            plain.append([i])
    fill = lambda rs: sorted(sum(lengths[k] for k in r) for r in rs)
    assert fill(rows) == fill(plain) and sorted(k for r in rows for k in r) == list(range(300))


@pytest.mark.parametrize("buffer_ids", [900, 4_000_000])
def test_matrices_round_trip(spark, text_ids, buffer_ids):
    rows = awkward()
    packed = token_output.packed_matrices(documents(spark, rows, clashing=True), rows_per_matrix=3, buffer_ids=buffer_ids).cache()
    for m in packed.collect():
        assert len(m.ids) == 2 * m.n_rows * m.row_ids and m.cu_seqlens[0] == 0 and m.cu_seqlens[-1] == m.n_rows * m.row_ids
        assert m.cu_seqlens == sorted(set(m.cu_seqlens)) and m.resets == [s.offset for s in m.segments]
        assert set(m.resets) <= set(m.cu_seqlens)
        assert all(s.offset // m.row_ids == (s.offset + s.length - 1) // m.row_ids for s in m.segments)
    got = Counter((p.doc, p.start, bytes(p.ids)) for p in token_output.piece_ids(packed).collect())
    want = Counter()
    for i, text, _ in rows:
        ids = np.array(text_ids(text) + [token_output.END_ID], "<u2")
        want.update((i, k, ids[k:k + 1024].tobytes()) for k in range(0, len(ids), 1024))
    assert got == want


def test_written_matrices_read_back(spark, tmpdir_fresh):
    packed = token_output.packed_matrices(documents(spark, awkward()))
    token_output.write_packed(packed, f"{tmpdir_fresh}/out")
    assert spark.read.parquet(f"{tmpdir_fresh}/out").count() == packed.count()
