"""Packed token-id matrices: best-fit-decreasing packing with a segment tree.

Documents (ids and an end id) are split losslessly into pieces of at most one
row.  Within a buffer, pieces are placed longest first into the open row with
the least room that still holds them; a segment tree over the room left
(0 .. row length) finds that row in a step per level.  Rows are written as
little-endian id matrices with the cumulative segment lengths that variable
length attention takes, and the offsets at which positions restart.

Scale: each task packs its own rows in buffers of ``buffer_ids`` ids; nothing
is shuffled and no id leaves its task but in a finished matrix.

Defined results: null or empty text is the end id alone; the string of the
vocabulary's added token, whose id ends a document here, is ordinary text in
one; repeated rows are documents of their own; null ids are carried; an empty table gives no matrix;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwave.llm.tokenizer import byte_bpe

ROW_IDS = 1024
END_ID = 50256
ROWS_PER_MATRIX = 64
BUFFER_IDS = 4_000_000


class RoomTree:
    """Segment tree over the room left in open rows: which rooms occur."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = room + self.size
        while at and not self.any[at]:
            self.any[at] = 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room of at least ``need``, removed."""
        at = need + self.size
        if not self.any[at]:
            while not (at & 1 == 0 and self.any[at + 1]):  # up, to a right neighbour that holds a room
                at >>= 1
                if at <= 1:
                    return None
            at += 1
            while at < self.size:  # down, leftmost
                at <<= 1
                if not self.any[at]:
                    at += 1
        room = at - self.size
        row = self.rows[room].pop()
        if not self.rows[room]:
            while at and not (at < self.size and (self.any[2 * at] or self.any[2 * at + 1])):
                self.any[at] = 0
                at >>= 1
        return room, row


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows as lists of piece numbers; longest pieces first, ties in order."""
    tree, rows = RoomTree(capacity), []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[piece])
        room, row = found or (capacity, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > lengths[piece]:
            tree.add(room - lengths[piece], row)
    return rows


def _writer(row_ids, end_id, rows_per_matrix, buffer_ids, vocabulary, schema: pa.Schema, dtype: str):
    def write(batches):
        from pyspark import TaskContext

        coder, end = byte_bpe(vocabulary), np.array([end_id], np.uint32)
        next_id = TaskContext.get().partitionId() << 40
        pieces, held = [], 0

        def matrices():
            nonlocal next_id
            rows = best_fit([len(p[2]) for p in pieces], row_ids)
            for k in range(0, len(rows), rows_per_matrix):
                part = rows[k:k + rows_per_matrix]
                ids = np.full((len(part), row_ids), end_id, dtype)
                ends, resets, segments = [0], [], []
                for r, row in enumerate(part):
                    at = 0
                    for i in row:
                        doc, start, piece = pieces[i]
                        ids[r, at:at + len(piece)] = piece
                        resets.append(r * row_ids + at)
                        segments.append({"doc": doc, "start": start, "offset": r * row_ids + at, "length": len(piece)})
                        at += len(piece)
                        ends.append(r * row_ids + at)
                    if at < row_ids:
                        ends.append((r + 1) * row_ids)
                values = (next_id, len(part), row_ids, dtype, ids.tobytes(), ends, resets, segments)
                next_id += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.concatenate((coder.encode(text.as_py()), end)).astype(dtype)
                pieces += [(doc, at, ids[at:at + row_ids]) for at in range(0, len(ids), row_ids)]
                held += len(ids)
                if held >= buffer_ids:
                    yield from matrices()
                    pieces, held = [], 0
        yield from matrices()
    return write


def packed_matrices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_ids: int = ROW_IDS,
                    end_id: int = END_ID, rows_per_matrix: int = ROWS_PER_MATRIX, buffer_ids: int = BUFFER_IDS,
                    vocabulary: str | None = None, dtype: str = "<u2") -> DataFrame:
    """One row per matrix:

    ``matrix_id``, ``n_rows``, ``row_ids``, ``dtype``; ``ids`` (the matrix, row
    by row, padded with the end id); ``cu_seqlens`` (cumulative segment
    lengths over the matrix read as one sequence, padding as a segment of its
    own); ``resets`` (offsets at which positions start at 0 again);
    ``segments`` (doc, start in the document, offset, length).
    """
    slim = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    segment = T.StructType([T.StructField("doc", slim.schema[0].dataType), T.StructField("start", T.LongType()),
                            T.StructField("offset", T.IntegerType()), T.StructField("length", T.IntegerType())])
    schema = T.StructType([
        T.StructField("matrix_id", T.LongType()), T.StructField("n_rows", T.IntegerType()),
        T.StructField("row_ids", T.IntegerType()), T.StructField("dtype", T.StringType()),
        T.StructField("ids", T.BinaryType()), T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("resets", T.ArrayType(T.IntegerType())), T.StructField("segments", T.ArrayType(segment))])
    from pyspark.sql.pandas.types import to_arrow_schema

    return slim.mapInArrow(
        _writer(row_ids, end_id, rows_per_matrix, buffer_ids, vocabulary, to_arrow_schema(schema), dtype), schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write matrices to a folder that all executors share; ids stay binary."""
    packed.write.mode("error").parquet(path)


def piece_ids(packed: DataFrame) -> DataFrame:
    """The pieces back from their matrices: ``doc, start, length, ids``
    (binary, in the matrix's type)."""
    width = F.when(F.col("dtype").endswith("2"), 2).otherwise(4)
    s = F.col("s")
    return (packed.select("ids", width.alias("w"), F.explode("segments").alias("s"))
            .select(s["doc"].alias("doc"), s["start"].alias("start"), s["length"].alias("length"),
                    F.substring(F.col("ids"), s["offset"] * F.col("w") + 1, s["length"] * F.col("w")).alias("ids")))
