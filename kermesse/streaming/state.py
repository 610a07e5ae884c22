"""Stateful processors: what a stream keeps of each series and of each host."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kermesse.schemas import CANDIDATE

DAY_MS = 86_400_000

# -- seasons ----------------------------------------------------------------------------------

_FIELDS = CANDIDATE.replace(" ", ": ").replace(",: ", ", ")
#: A season's partial result: mergeable in any order, finished by ``season_rows``.
SEASON = (f"desde bigint, hasta bigint, n bigint, midnight boolean, first struct<t: timestamp_ntz, s: bigint, row: struct<{_FIELDS}>>, "
          "last struct<t: timestamp_ntz, s: bigint, end: timestamp_ntz>, max_end timestamp_ntz, "
          "ptext struct<t: timestamp_ntz, s: bigint, v: string>, price struct<t: timestamp_ntz, s: bigint, p: int, g: boolean>, "
          "image struct<t: timestamp_ntz, s: bigint, v: string>")
SEASON_NAMES = ("desde", "hasta", "n", "midnight", "first", "last", "max_end", "ptext", "price", "image")


def _first(a: tuple | None, b: tuple | None) -> tuple | None:
    return b if a is None else a if b is None or a[:2] <= b[:2] else b


def _merged(a: tuple, b: tuple) -> tuple:
    last = max(a[5], b[5], key=lambda x: (x[0], x[1]))
    return (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2], a[3] and b[3], _first(a[4], b[4]), last, max(a[6], b[6]),
            *(_first(a[i], b[i]) for i in (7, 8, 9)))


class Seasons(StatefulProcessor):
    """Open seasons of a series, as disjoint runs of days more than ``gap`` apart, from partial ones."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seasons = handle.getListState("temporadas", SEASON)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = [_plain(s) for s in self.seasons.get()]
        for r in rows:
            own = tuple(_plain(r[c]) for c in SEASON_NAMES)
            near = [s for s in held if own[0] <= s[1] + self.gap and own[1] >= s[0] - self.gap]
            held = [s for s in held if s not in near]
            for s in near:
                own = _merged(s, own)
            held.append(own)
        self.seasons.put(held)
        for closes in {self._closes(s) for s in held}:
            self.handle.registerTimer(closes)
        return iter(())

    def _closes(self, season: tuple) -> int:
        """When every day that could join the season has passed."""
        return (season[1] + self.gap + 1) * DAY_MS

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        held = [_plain(s) for s in self.seasons.get()]
        done = [s for s in held if self._closes(s) <= passed]
        if done:
            rest = [s for s in held if self._closes(s) > passed]
            if rest:
                self.seasons.put(rest)
            else:
                self.seasons.clear()
        for s in done:
            yield Row(**dict(zip(SEASON_NAMES, s)))

    def close(self) -> None:
        pass


def _plain(x):
    """A struct as a tuple: rows bring it as a dict in the order of its fields, the state as a tuple."""
    return tuple(_plain(v) for v in (x.values() if isinstance(x, dict) else x)) if isinstance(x, (dict, tuple)) else x


# -- failure circuit --------------------------------------------------------------------------

CIRCUIT = "host string, racha bigint, peor bigint, abierto boolean"


#: A fetch while it is counted: 17 bytes, where a row of Python objects takes some two hundred.
FETCH = np.dtype([("us", "<i8"), ("seq", "<i8"), ("ok", "?")])
#: Fetches that are Python rows at a time, on their way from and to the state.
CHUNK = 10_000


def _packed(rows: Iterator[tuple]) -> list[np.ndarray]:
    return [np.array(part, dtype=FETCH) for part in iter(lambda: [tuple(r) for r in islice(rows, CHUNK)], [])]


def count_failures(every: np.ndarray, run: int, worst: int, passed: int) -> tuple[tuple[int, int], tuple[int, int], int]:
    """The counter after the fetches up to ``passed`` and after all, and how many those are; ``every`` is in order."""
    n = np.arange(len(every))
    last = np.maximum.accumulate(np.where(every["ok"], n, -1))
    runs = np.where(last < 0, run + n + 1, n - last)
    done = int(np.searchsorted(every["us"], passed, side="right"))

    def after(k: int) -> tuple[int, int]:
        return (int(runs[k - 1]), max(worst, int(runs[:k].max()))) if k else (run, worst)

    return after(done), after(len(every)), done


class Circuit(StatefulProcessor):
    """Failures in a row of a host, now and at worst."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("asentado", "racha bigint, peor bigint")
        self.pending = handle.getListState("pendientes", "us bigint, seq bigint, ok boolean")
        self.now = handle.getValueState("ahora", "racha bigint, peor bigint, abierto boolean")

    def _count(self, parts: list[np.ndarray], passed: int) -> tuple[int, int, int | None]:
        """Settle the fetches up to the watermark, keep the others; the counter over all and the newest time."""
        every = np.concatenate([np.empty(0, FETCH), *parts])
        parts.clear()
        every = every[np.lexsort((every["seq"], every["us"]))]
        before, (run, worst), done = count_failures(every, *(self.settled.get() or (0, 0)), passed * 1000)
        self.settled.update(before)
        if self.pending.exists():
            self.pending.clear()
        for k in range(done, len(every), CHUNK):
            self.pending.appendList(every[k:k + CHUNK].tolist())
        self.now.update((run, worst, run >= self.limit))
        return run, worst, int(every["us"][-1]) if len(every) else None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.now.get()
        run, worst, newest = self._count(_packed(self.pending.get()) + _packed((r.us, r.seq, r.ok) for r in rows), timerValues.getCurrentWatermarkInMs())
        if newest is not None:
            self.handle.registerTimer(-(-newest // 1000))
        if before is None or tuple(before)[:2] != (run, worst):
            yield Row(host=key[0], racha=run, peor=worst, abierto=run >= self.limit)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._count(_packed(self.pending.get()), timerValues.getCurrentWatermarkInMs())
        return iter(())

    def close(self) -> None:
        pass
