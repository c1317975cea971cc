"""Map-side combination ahead of stateful processors.

``transformWithState`` receives every row of a key.  The functions here count
in the map tasks of each micro-batch first, so that a key that holds a third
of all rows sends a few rows a task.  They also keep event time whole: what a
job leaves out, or what is combined away, is still represented by the largest
time it had, and the watermark is taken after the combination.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups that a map task holds before it hands them on.
HELD_GROUPS = 100_000


def combined(df: DataFrame, keys: list[str], ts: str, keep: Column, first: tuple[str, ...] = ()) -> DataFrame:
    """``keys, first, n, ts``: per map task and key, the columns ``first`` of
    the row with the smallest values of them, the number of rows with ``keep``
    and their largest ``ts``.  Rows without ``keep`` come as rows of null keys
    and ``n = 0``; rows without a time are rejects."""
    kept = F.coalesce(keep, F.lit(False))
    cols = [F.when(kept, F.col(k)).alias(k) for k in [*keys, *first]]
    rows = df.where(F.col(ts).isNotNull()).select(*cols, kept.cast("bigint").alias("n"), F.col(ts).alias("_ts"))
    names = [*keys, *first, "n", "_ts"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            parts = pa.Table.from_batches([batch])
            parts = parts if held is None else pa.concat_tables([held, parts])
            if first:
                parts = parts.sort_by([(c, "ascending") for c in first])
            groups = parts.group_by(keys, use_threads=False).aggregate([*((c, "first") for c in first), ("n", "sum"), ("_ts", "max")])
            held = pa.table([groups.column(c) for c in (*keys, *(f"{c}_first" for c in first), "n_sum", "_ts_max")],
                            names=names).cast(parts.schema)
            if held.num_rows > HELD_GROUPS:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return rows.mapInArrow(count, rows.schema).withColumnRenamed("_ts", ts)


def dealt(df: DataFrame, group: str, by: str, ts: str, salts: int) -> DataFrame:
    """``df`` with a ``salt`` from the hash of ``by``, and for every ``group``
    of a map task one row with ``mark`` for each salt, its other columns null:
    a processor keyed by the salt learns of all groups of its micro-batch."""
    salted = df.withColumns({"salt": F.pmod(F.xxhash64(by), F.lit(salts)).cast("long"), "mark": F.lit(False)})

    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            held = pa.Table.from_batches([batch])
            held = held.filter(pa.compute.greater(held.column("n"), 0))
            groups = held.group_by(group).aggregate([(ts, "max")])
            n = groups.num_rows
            marks = {group: groups.column(group), ts: groups.column(f"{ts}_max")}
            for salt in range(salts if n else 0):
                columns = []
                for field in batch.schema:
                    if field.name in marks:
                        columns.append(marks[field.name].combine_chunks().cast(field.type))
                    elif field.name in ("n", "salt", "mark"):
                        columns.append(pa.array([{"n": 0, "salt": salt, "mark": True}[field.name]] * n, field.type))
                    else:
                        columns.append(pa.nulls(n, field.type))
                yield from pa.table(columns, schema=batch.schema).to_batches()

    return salted.mapInArrow(announce, salted.schema)


def packed(df: DataFrame, keys: list[str], columns: list[str], ts: str) -> DataFrame:
    """One row per key and batch of a map task, its ``columns`` as arrays: what
    a processor reads in one piece costs it far less than row by row."""
    rows = df.select(*keys, *columns, ts)
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys),
                        *(f"`{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in columns), f"`{ts}` timestamp"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = pa.Table.from_batches([batch]).group_by(keys, use_threads=False).aggregate(
                [*((c, "list") for c in columns), (ts, "max")])
            yield from pa.table([groups.column(c) for c in (*keys, *(f"{c}_list" for c in columns), f"{ts}_max")],
                                names=[*keys, *columns, ts]).to_batches()

    return rows.mapInArrow(pack, schema)
