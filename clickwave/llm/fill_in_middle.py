"""Fill-in-middle texts, cut by an indexable skip list.

A text is a row of units (by default its code points; any pattern can be the
unit).  The skip list over it has a node per unit, in express lanes of fewer
and fewer nodes; every link carries how many units and how many code points it
passes over.  A cut of rank ``r`` is found by descending from the top lane:
follow a link while the units passed stay at most ``r``, else go down a lane;
the code points passed at the end are where the text is cut, whatever the
width of its units.  Heights of nodes depend on their rank alone, so that a
list is the same in every run and its upper lanes are laid out once per task.

The two cut ranks, and the form of the result, come from a hash of the
document's id: prefix, middle and suffix are put out as they are (``plain``),
as prefix-suffix-middle (``psm``) or as suffix-prefix-middle (``spm``).  A text
that holds a sentinel stays plain, so every result can be taken apart again
(:func:`restored`).

Scale: one pass without a shuffle; memory is a batch of texts and, for one text
at a time, its list (two integers a unit).

Defined results: null text is the empty text, and an empty text is plain; a
null id is hashed as an empty string; repeated rows are cut alike; an empty
table gives no rows; extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents: so many take part, and so many of those suffix first.
RATE, SPM_RATE = 90, 20
#: One node in so many reaches the next lane.
_LANE = 8


class _Towers:
    """Ranks of the nodes of every lane, up to the longest list asked for."""

    def __init__(self):
        self.size, self.lanes = 0, []

    def upto(self, n: int) -> list[np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * self.size, 4096)
            mixed = np.arange(self.size, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of splitmix64
                mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
            lane, self.lanes = np.arange(self.size), []
            while len(lane) > 1:
                self.lanes.append(lane)
                mixed = mixed // np.uint64(_LANE)
                lane = lane[(mixed[lane] % np.uint64(_LANE) == 0) | (lane == 0)]
        return [lane[:np.searchsorted(lane, n)] for lane in self.lanes]


@lru_cache(maxsize=1)
def _towers() -> _Towers:
    return _Towers()


class SkipList:
    """An indexable skip list over units of the given widths in code points."""

    def __init__(self, widths: np.ndarray):
        n = len(widths)
        self.lanes, below = [], None
        for at in _towers().upto(n):
            units = np.diff(at, append=n)
            points = np.asarray(widths) if below is None else np.add.reduceat(self.lanes[-1][1], below_of(at, below))
            down = None if below is None else np.append(below_of(at, below), len(below))
            self.lanes.append((units, points, down))
            below = at
            if len(at) < 2:
                break

    def offset(self, rank: int) -> int:
        """Code points before the unit of this rank."""
        node = units = points = 0
        for lane_units, lane_points, down in reversed(self.lanes):
            while node < len(lane_units) and units + lane_units[node] <= rank:
                units += int(lane_units[node])
                points += int(lane_points[node])
                node += 1
            if down is not None:
                node = int(down[node])
        return points


def below_of(at: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Where the nodes of a lane stand in the lane below it."""
    return np.searchsorted(below, at)


def unit_widths(text: str, unit: str | None = None) -> np.ndarray:
    """Width of every unit in code points; a unit goes up to the next match."""
    if unit is None:
        return np.ones(len(text), np.int64)
    starts = np.array([m.start() for m in re.finditer(unit, text, re.DOTALL)], np.int64)
    if len(starts):
        starts[0] = 0
    return np.diff(starts, append=len(text))


def _draws(doc_id, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def rearranged(doc_id, text: str | None, unit: str | None = None, seed: str = "1:") -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, code points of prefix and middle, and the result."""
    text = text or ""
    widths = unit_widths(text, unit)
    n = len(widths)
    h1, h2, h3, h4 = _draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= RATE:
        return n, "plain", None, None, text
    units = SkipList(widths)
    a, b = (units.offset(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_RATE:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str | None = None,
                   seed: str = "1:") -> DataFrame:
    """``id, n, form, prefix_chars, middle_chars, output`` of each document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            made = [rearranged(i, t, unit, seed) for i, t in zip(ids.to_pylist(), batch.column(1).to_pylist())]
            n, form, prefix, middle, output = zip(*made) if made else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(cut, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that a result was made from."""
    first, last = F.substring_index, lambda c, mark: F.substring_index(c, mark, -1)
    middle = last(output, MIDDLE)
    psm = F.concat(last(first(output, SUFFIX, 1), PREFIX), middle, last(first(output, MIDDLE, 1), SUFFIX))
    spm = F.concat(last(first(output, MIDDLE, 1), PREFIX), middle, last(first(output, PREFIX, 1), SUFFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle_digests(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """What :func:`fill_in_middle` gives, with hashes in place of the texts."""
    made = fill_in_middle(docs, id_col, **options)
    return made.select(id_col, "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
