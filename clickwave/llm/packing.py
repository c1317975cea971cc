"""Packing documents into fixed-length sequences by minimum bin slack.

A document's ids (with an end id) are cut into pieces of the capacity and a
remainder.  Full pieces are sequences of their own.  Remainders are packed
window by window: the longest one left opens the window, and a subset-sum
dynamic program over the multiset of remaining lengths (a bitset of reachable
sums, one step per distinct length) finds the subset that fills the rest of
the window closest to its capacity; walking back through the bitsets gives how
often each length is used.  The same choice is repeated while the multiset
allows it.  When not even the best subset comes within ``max_slack`` ids of the
capacity, which happens at the end of a buffer, one more remainder is cut to
fill the window.

Scale: each task packs what it reads, in buffers of ``buffer_pieces``
remainders, and hands the last tenth of a buffer on to the next one, so at
most one sequence per task is left short.  Nothing is shuffled; memory is
bounded by the buffer; a lost task is packed again from the same rows.

Defined results: null or empty text is the end id alone; the string of the
vocabulary's added token is that token; repeated rows are packed as documents of their own; a null id is carried; an empty table gives
no pieces; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.llm.tokenizer import byte_bpe

CAPACITY = 1024
END_ID = 0
BUFFER_PIECES = 20_000
MAX_SLACK = 8


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How often to take each length so that the sum is closest to ``room``
    without exceeding it.  ``counts``: lengths left, with their numbers."""
    mask, goal = (1 << (room + 1)) - 1, 1 << room
    reach, steps = 1, []
    for length in sorted((n for n in counts if 0 < n <= room), reverse=True):
        steps.append((length, reach))
        left, shift = min(counts[length], room // length), 1
        while left > 0:  # bounded multiples by binary splitting
            shift = min(shift, left)
            reach |= (reach << (shift * length)) & mask
            left -= shift
            shift *= 2
        if reach & goal:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            used[length] = n
    return used


def fill_windows(counts: dict[int, int], capacity: int, leave: int, max_slack: int) -> Iterator[tuple[list[int], int, int, int]]:
    """Windows over a multiset of lengths (which is used up, down to
    ``leave`` pieces): ``(lengths, times, cut length, ids taken of it)``.
    The rest of a cut piece goes back into the multiset."""
    pieces = sum(counts.values())
    while pieces > leave:
        first = max(counts)
        lengths = [first]
        _take(counts, first, 1)
        used = best_fill(counts, capacity - first)
        for length, n in used.items():
            lengths += [length] * n
            _take(counts, length, n)
        slack = capacity - sum(lengths)
        pieces -= len(lengths)
        times = 1
        if slack <= max_slack:
            need = dict(used)
            need[first] = need.get(first, 0) + 1
            more = min(counts.get(length, 0) // n for length, n in need.items())
            more = min(more, max(0, (pieces - leave) // len(lengths)))
            for length, n in need.items():
                _take(counts, length, n * more)
            pieces -= more * len(lengths)
            times += more
        elif counts:
            cut = max(counts)  # longer than the slack, else it would be in the window
            _take(counts, cut, 1)
            counts[cut - slack] = counts.get(cut - slack, 0) + 1
            yield lengths, 1, cut, slack
            continue
        elif leave:  # all that is left does not fill a window, and more will come
            return
        yield lengths, times, 0, 0


def _take(counts: dict[int, int], length: int, n: int) -> None:
    if n:
        counts[length] -= n
        if not counts[length]:
            del counts[length]


class _Pieces:
    """Remainders waiting for a window, by length: (id, start, doc tokens, ids)."""

    def __init__(self):
        self.by_length: dict[int, list] = {}
        self.n = 0

    def add(self, piece) -> None:
        self.by_length.setdefault(len(piece[3]), []).append(piece)
        self.n += 1

    def pop(self, length: int):
        held = self.by_length[length]
        piece = held.pop()
        if not held:
            del self.by_length[length]
        self.n -= 1
        return piece


def _packer(capacity: int, end_id: int, buffer_pieces: int, max_slack: int, vocabulary: str | None, schema: pa.Schema):
    def pack(batches):
        from pyspark import TaskContext

        coder, end = byte_bpe(vocabulary, added_tokens=True), np.array([end_id], np.uint32)
        next_id = TaskContext.get().partitionId() << 40
        waiting, rows = _Pieces(), []

        def emit(piece, offset):
            doc, start, total, ids = piece
            rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, next_id, offset))

        def flush(leave):
            nonlocal next_id
            counts = {n: len(held) for n, held in waiting.by_length.items()}
            for lengths, times, cut, part in fill_windows(counts, capacity, leave, max_slack):
                for _ in range(times):
                    offset = 0
                    for n in lengths:
                        emit(waiting.pop(n), offset)
                        offset += n
                    if cut:
                        doc, start, total, ids = waiting.pop(cut)
                        emit((doc, start, total, ids[:part]), offset)
                        waiting.add((doc, start + part, total, ids[part:]))
                    next_id += 1

        def table():
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate((coder.encode(text.as_py()), end)).astype("<u4", copy=False)
                total = len(ids)
                for start in range(0, total - total % capacity, capacity):
                    emit((doc, start, total, ids[start:start + capacity]), 0)
                    next_id += 1
                if total % capacity:
                    start = total - total % capacity
                    waiting.add((doc, start, total, ids[start:].copy()))
                if waiting.n >= buffer_pieces:
                    flush(max(1, buffer_pieces // 10))
            if rows:
                yield table()
        flush(0)
        if rows:
            yield table()
    return pack


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, buffer_pieces: int = BUFFER_PIECES, max_slack: int = MAX_SLACK,
                   vocabulary: str | None = None) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``.

    ``sequence_id`` is unique in one run of the query over one reading of the
    input; a piece's ids are those of the document from ``start`` on.
    """
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    schema = T.StructType([T.StructField(id_col, slim.schema[0].dataType)] + [
        T.StructField(n, T.LongType()) for n in
        ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return slim.mapInArrow(_packer(capacity, end_id, buffer_pieces, max_slack, vocabulary, arrow), schema)
