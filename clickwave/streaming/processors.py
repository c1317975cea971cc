"""Keyed stateful processors: click cap (R5-R7), sliding counts (W2, A1), page
rankings with revisions (T2, R3), new visitors (A7, A8)."""

from __future__ import annotations

import bisect
import heapq
import json
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MS = 86_400_000

# Processors are shipped to Python workers -- including the driver-side
# worker that sets up state schemas -- by value, so no worker needs this
# package on its path.
from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _named(pdf: pd.DataFrame, columns: list[str] | None) -> pd.DataFrame:
    """Input batches may carry computed columns without their names; the
    columns arrive in the order of the input DataFrame."""
    if columns and list(pdf.columns) != list(columns) and len(pdf.columns) == len(columns):
        pdf = pdf.set_axis(list(columns), axis=1)
    return pdf


class ClickCapProcessor(StatefulProcessor):
    """Per ``keys`` tuple, as (user, ad): pass the first ``cap`` clicks of each
    reset day, give one ``alert`` row for the first click over the cap, drop
    the rest.  Their times come as ``_us``, microseconds, and leave as ``ts``.

    A group is a bucket of key tuples and a reset day, ``_day_end`` the epoch
    millisecond at which that day ends: state, timer and output batch cost a
    group milliseconds, too much for a key that has a click or two.  Clicks of
    a micro-batch are ordered by ``order`` before counting; of a key's clicks
    only those that can still pass and the first one over the cap are held, so
    a bot's clicks do not pile up.

    The state is what each key has had, its passed clicks and its alert: one
    value in a small bucket, in a large one chunks in a map, of which only
    those that come are read.  An event-time timer at the day end clears it.
    """

    #: Counts kept as one value, chunks of a larger bucket, clicks held before they are sifted.
    FEW, CHUNKS, HELD = 20_000, 256, 50_000

    def __init__(self, cap: int, keys: tuple[str, ...], columns: list[str], order: tuple[str, ...] = ("_us", "offset")):
        self.cap, self.keys, self.columns, self.order = int(cap), list(keys), list(columns), list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cap", "counts string, day_end long")
        self.chunks = handle.getMapState("chunks", "chunk int", "counts string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        st = self.state.get()
        few = {} if st is None else None if st[0] is None else self._counts(st[0])
        chunks, held, size, most = {}, [], 0, self.HELD

        def had(who):
            return (self._chunk(chunks, who) if few is None else few).get(who, 0)

        for pdf in rows:
            held.append(_named(pdf, self.columns))
            size += len(pdf)
            if size > most:
                held = [self._sifted(pd.concat(held, ignore_index=True), had)[0]]
                size, most = len(held[0]), max(self.HELD, 2 * len(held[0]))
        if not size:
            return
        out, new = self._sifted(pd.concat(held, ignore_index=True), had)
        if new:
            day_end = int(out["_day_end"].iloc[0])
            if st is None:
                self.handle.registerTimer(day_end)
            self._store(new, few, chunks, day_end)
            yield out.assign(ts=out["_us"].astype("datetime64[us]").dt.tz_localize("UTC"))

    def _sifted(self, pdf: pd.DataFrame, had) -> tuple[pd.DataFrame, dict[tuple, int]]:
        """The clicks that pass or alert, with their ``kind``, and the new counts of their keys."""
        pdf = pdf.sort_values(self.order, kind="stable", ignore_index=True)
        seen, kept, kinds = {}, [], []
        for at, who in enumerate(zip(*(pdf[c].tolist() for c in self.keys))):
            n = seen.get(who)
            n = had(who) if n is None else n
            seen[who] = n + 1
            if n <= self.cap:
                kept.append(at)
                kinds.append("ok" if n < self.cap else "alert")
        out = pdf.take(kept).assign(kind=kinds)
        new = dict.fromkeys(zip(*(out[c].tolist() for c in self.keys)))
        return out, {who: min(seen[who], self.cap + 1) for who in new}

    @staticmethod
    def _counts(text: str) -> dict[tuple, int]:
        return {tuple(who): n for *who, n in json.loads(text)}

    @staticmethod
    def _text(counts: dict[tuple, int]) -> str:
        return json.dumps([[*who, n] for who, n in counts.items()])

    def _at(self, who: tuple) -> int:
        return zlib.crc32(json.dumps(who).encode()) % self.CHUNKS

    def _chunk(self, chunks: dict[int, dict], who: tuple) -> dict[tuple, int]:
        """The counts of the chunk of ``who``, read once."""
        at = self._at(who)
        if at not in chunks:
            held = self.chunks.getValue((at,))
            chunks[at] = {} if held is None else self._counts(held[0])
        return chunks[at]

    def _store(self, new: dict[tuple, int], few: dict | None, chunks: dict[int, dict], day_end: int) -> None:
        if few is not None:
            few.update(new)
            if len(few) <= self.FEW:
                self.state.update((self._text(few), day_end))
                return
            self.state.update((None, day_end))
            new = few
        for who, n in new.items():
            self._chunk(chunks, who)[who] = n
        for at in {self._at(who) for who in new}:
            self.chunks.updateValue((at,), (self._text(chunks[at]),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        st = self.state.get()
        if st is not None and st[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
            if st[0] is None:
                self.chunks.clear()
        return iter([])

    def close(self) -> None:
        pass


class ClickCapRowProcessor(StatefulProcessor):
    """Row form of :class:`ClickCapProcessor` for ``transformWithState``, with
    a state and a timer for each key and reset day; same output.

    A loop over Rows avoids building a pandas frame per key.  Of a key's clicks only those that can still pass and the first one over the
    cap matter: a bounded heap holds at most ``cap + 1`` of them, however many
    a bot sends.
    """

    def __init__(self, cap: int, order: tuple[str, ...] = ("ts", "offset")):
        self.cap = int(cap)
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cap", "clicks long, sent boolean, day_end long")

    def handleInputRows(self, key, rows, timerValues):
        from pyspark.sql import Row
        st = self.state.get()
        clicks, sent, day_end = st if st is not None else (0, False, -1)
        room = self.cap - clicks + (not sent)
        first = heapq.nsmallest(room, rows, key=lambda r: tuple(r[c] for c in self.order))
        if not first:
            for _ in rows:  # the cap was reached before: read past these clicks
                pass
            return
        if st is None:
            day_end = first[0]["_day_end"]
            self.handle.registerTimer(int(day_end))
        passed = first[:self.cap - clicks]
        over = first[self.cap - clicks:]
        self.state.update((int(clicks + len(passed)), bool(sent or over), int(day_end)))
        for r in passed:
            yield Row(**r.asDict(), kind="ok")
        for r in over:
            yield Row(**r.asDict(), kind="alert")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        st = self.state.get()
        if st is not None and st[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def add_steps(at: list[int], level: list[int], ranges: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """A step function (``level[k]`` from ``at[k]`` on, 0 at its end) plus
    ``c`` on each ``[a, b)``; points without a step are left out."""
    a, b, c = (np.array(x, np.int64) for x in zip(*ranges)) if ranges else (np.empty(0, np.int64),) * 3
    points = np.concatenate([np.array(at, np.int64), a, b])
    steps = np.concatenate([np.diff(np.array(level, np.int64), prepend=0), c, -c])
    points, where = np.unique(points, return_inverse=True)
    total = np.zeros(len(points), np.int64)
    np.add.at(total, where, steps)
    kept = total != 0
    return points[kept].tolist(), np.cumsum(total[kept]).tolist()


class _Timed(StatefulProcessor):
    """A processor whose state outlives Spark's watermark: the stream's delay
    is widened by ``wider_ms``, so that a row that is late for some windows
    still arrives, and the job's own watermark is that much ahead."""

    wider_ms = 0

    def now(self, timer_values) -> int | None:
        """The job's watermark in ms; None before the first one."""
        wm = timer_values.getCurrentWatermarkInMs()
        return wm + self.wider_ms if wm and wm > 0 else None

    def wake(self, old: int, at_ms: int | None) -> int:
        """Have the only timer fire once the job's watermark is ``at_ms``."""
        new = -1 if at_ms is None else at_ms - self.wider_ms - 1
        if new != old:
            if old >= 0:
                self.handle.deleteTimer(old)
            if new >= 0:
                self.handle.registerTimer(new)
        return new

    def close(self) -> None:
        pass


class SlidingRunsProcessor(_Timed):
    """Final sliding-window counts of a key as runs of window ends.

    The state is the count as a step function over the window ends that are not
    yet final, two steps a pane at most (W2 over A1): a pane adds its count to
    the windows it is in, those only that the watermark has not passed.  A timer
    at the next end emits what became final.  ``whole`` holds a run back until
    it is over, so that none is split where micro-batches meet.
    """

    def __init__(self, keys: list[str], size_s: int, slide_s: int, whole: bool):
        self.keys, self.size, self.slide, self.whole = keys, size_s, slide_s, whole
        self.wider_ms = (size_s - slide_s) * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("runs", "timer long, at array<long>, cnt array<long>")

    def handleInputRows(self, key, rows, timerValues):
        now = self.now(timerValues)
        opened = -(1 << 62) if now is None else (now // 1000 // self.slide + 1) * self.slide
        held = self.state.get()
        timer, at, cnt = (-1, [], []) if held is None else (held[0], list(held[1]), list(held[2]))
        ranges = []
        for r in rows:
            start, until = max(r["pane_end"], opened), r["pane_end"] + self.size
            if start < until:
                ranges.append((start, until, r["n"]))
        if ranges:
            self._store(timer, *add_steps(at, cnt, ranges))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        from pyspark.sql import Row
        held, now = self.state.get(), self.now(timerValues)
        if held is None or now is None:
            return
        at, cnt = list(held[1]), list(held[2])
        final = (now // 1000 // self.slide + 1) * self.slide  # ends below it
        names, done = dict(zip(self.keys, key)), 0
        while done < len(at) - 1 and at[done] < final and (at[done + 1] <= final or not self.whole):
            until = min(at[done + 1], final)
            if cnt[done] > 0:
                yield Row(**names, window_end_from=at[done], window_end_until=until, cnt=cnt[done])
            if until < at[done + 1]:
                at[done] = until
                break
            done += 1
        self._store(-1, at[done:], cnt[done:])

    def _store(self, timer: int, at: list[int], cnt: list[int]) -> None:
        if len(at) < 2:
            self.state.clear()
            return
        due = at[1] - self.slide if self.whole else at[0]
        self.state.update((self.wake(timer, due * 1000), at, cnt))


class PageRankingProcessor(_Timed):
    """The ``n`` most requested pages of every window of a block of window
    ends, among the pages of one salt.

    The state is, per page, its count as a step function over the window ends
    and, per window, the leading pages now and as last issued.  Counts only
    grow, so a page enters a window's list only when it is counted itself, and
    the list is exact without the others.  The pages of a small block are kept
    with its lists, those of a large one in a map of their own, of which only
    the pages that come are read.  Once the watermark has passed a window, its
    list is put out, and again whenever a row of the block comes for it,
    whatever its salt (rows with ``mark`` say so), until ``lateness`` is over:
    ``was`` tells the list of the last issue from that of this one, so all
    salts of a micro-batch can be merged without further state.  A window that
    the watermark has passed is issued before the rows of the micro-batch are
    counted; they are late for it and make a ``revised`` issue.
    """

    #: Pages of a block that are kept with its lists.
    FEW = 500

    def __init__(self, n: int, block_s: int, size_s: int, slide_s: int, lateness_s: int):
        self.n, self.block, self.slide, self.lateness_ms = n, block_s, slide_s, lateness_s * 1000
        self.wider_ms = (lateness_s + size_s - slide_s) * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "url string", "at array<long>, cnt array<long>")
        self.state = handle.getValueState("lists", "timer long, lists string, pages string")

    def _load(self):
        """Timer, lists by window end, and the pages kept with them (None: in the map)."""
        held = self.state.get()
        if held is None:
            return -1, {}, {}
        return held[0], {int(e): v for e, v in json.loads(held[1]).items()}, None if held[2] is None else json.loads(held[2])

    def handleInputRows(self, key, rows, timerValues):
        now = self.now(timerValues)
        # open: end - 1 ms + lateness > watermark
        opened = -(1 << 62) if now is None else ((now - self.lateness_ms + 1) // 1000 // self.slide + 1) * self.slide
        timer, lists, few = self._load()
        yield from self._issue(lists, self._waiting(lists), now, revised=False)  # before late rows change them
        touched, pages = set(), {}
        for r in rows:
            for url, mark, low, until, n in zip(r["url"], r["mark"], r["low"], r["until"], r["n"]):
                low = max(low, opened)
                if low < until:
                    if now is not None:  # those it has passed
                        touched.update(range(low, min(until, -(-now // 1000)), self.slide))
                    if not mark:
                        pages.setdefault(url, []).append((low, until, n))
        for url, ranges in pages.items():
            held = self.counts.getValue((url,)) if few is None else few.get(url)
            at, cnt = add_steps(*(([], []) if held is None else held), ranges)
            if few is None:
                self.counts.updateValue((url,), (at, cnt))
            else:
                few[url] = (at, cnt)
            self._lead(lists, url, at, cnt, min(a for a, _, _ in ranges), max(b for _, b, _ in ranges))
        if few is not None and len(few) > self.FEW:
            for url, steps in few.items():
                self.counts.updateValue((url,), (list(steps[0]), list(steps[1])))
            few = None
        yield from self._issue(lists, touched & lists.keys(), now, revised=True)
        self._store(key, timer, lists, few, now)

    def _lead(self, lists, url, at, cnt, low, until) -> None:
        """Enter a page's counts for the window ends in [low, until)."""
        for k in range(max(bisect.bisect_right(at, low) - 1, 0), len(at) - 1):
            if at[k] >= until:
                break
            entry = [-cnt[k], url]
            for end in range(max(at[k], low), min(at[k + 1], until), self.slide) if cnt[k] else ():
                lead = lists.get(end)
                if lead is None:
                    lists[end] = [[entry], None]
                    continue
                best = lead[0]
                if len(best) == self.n and entry > best[-1]:
                    continue  # nor was it in the list: counts only grow
                best = [x for x in best if x[1] != url]
                bisect.insort(best, entry)
                lead[0] = best[:self.n]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = self.now(timerValues)
        _, lists, few = self._load()
        yield from self._issue(lists, self._waiting(lists), now, revised=False)
        self._store(key, -1, lists, few, now)

    def _waiting(self, lists) -> list[int]:
        return [e for e, (_, issued) in lists.items() if issued is None]

    def _issue(self, lists, ends, now, revised: bool):
        from pyspark.sql import Row
        out = []
        for end in sorted(ends) if now is not None else ():
            if end * 1000 >= now:  # the watermark has not passed it
                break
            leading, issued = lists[end]
            for was, pages in ((False, leading), (True, issued or [])):
                out += [{"end": end, "url": url, "cnt": -minus, "was": was, "revised": revised} for minus, url in pages]
            lists[end][1] = leading
        if out:
            yield Row(issued=json.dumps(out))

    def _store(self, key, timer, lists, few, now) -> None:
        last = key[0] * self.block + self.block  # the ends of a block lie in (block start, block end]
        waiting = self._waiting(lists)
        if not waiting and now is not None and last * 1000 - 1 + self.lateness_ms <= now:
            self.state.clear()
            if few is None:
                self.counts.clear()
            return
        due = min(waiting) * 1000 + 1 if waiting else last * 1000 - 1 + self.lateness_ms
        self.state.update((self.wake(timer, due), json.dumps(lists), None if few is None else json.dumps(few)))


class NewVisitorProcessor(_Timed):
    """First sightings of the bitmap offsets of a window, those of one salt.

    The state is the window's bitmap (A7): a list of offsets while they are
    few, then chunks of bits, of which only those that come are read.  A window
    that is counted in a micro-batch also gives its number ``before`` it,
    whether it has new visitors in this salt or not.
    """

    #: Offsets kept as a list, and bits of a chunk.
    FEW, BITS = 4096, 1 << 15

    def __init__(self, size_s: int):
        self.wider_ms = size_s * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk long", "bits binary")
        self.state = handle.getValueState("seen", "timer long, n long, few binary")

    def handleInputRows(self, key, rows, timerValues):
        from pyspark.sql import Row
        window_end, now = key[0], self.now(timerValues)
        if now is not None and window_end * 1000 <= now:
            return
        timer, n, few = self.state.get() or (-1, 0, b"")
        first = {}
        for r in rows:
            if not r["mark"]:
                off, at = (-1 if r["off"] is None else r["off"]), (r["first_ts"], r["offset"])
                first[off] = min(at, first.get(off, at))
        yield Row(window_end=window_end, off=None, ts=None, offset=None, before=n)
        if few is not None:
            held = set(np.frombuffer(bytes(few), "<i8").tolist())
            fresh = [off for off in first if off not in held]
            held.update(fresh)
            few = np.array(sorted(held), "<i8").tobytes() if len(held) <= self.FEW else None
            if few is None:
                self._into_chunks(held)
        else:
            fresh = self._into_chunks(first)
        for off in fresh:
            yield Row(window_end=window_end, off=off, ts=first[off][0], offset=first[off][1], before=None)
        self.state.update((self.wake(timer, window_end * 1000), n + len(fresh), few))

    def _into_chunks(self, offsets) -> list[int]:
        """Set the bits of these offsets; those that were not set."""
        by_chunk, fresh = {}, []
        for off in offsets:
            by_chunk.setdefault(off // self.BITS, []).append(off % self.BITS)
        for chunk, positions in by_chunk.items():
            held = self.chunks.getValue((chunk,))
            bits = np.zeros(self.BITS, np.uint8) if held is None else np.unpackbits(np.frombuffer(bytes(held[0]), np.uint8))
            new = [p for p in positions if not bits[p]]
            if new:
                bits[new] = 1
                self.chunks.updateValue((chunk,), (np.packbits(bits).tobytes(),))
                fresh += [chunk * self.BITS + p for p in new]
        return fresh

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.state.get()
        self.state.clear()
        if held is not None and held[2] is None:
            self.chunks.clear()
        return iter([])
