"""Sliding counts that are given out early, on time and again after a number of late rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracewell.session import prepare

EARLY, ON_TIME, LATE, LAST = "early", "on time", "late", "last"
_OUT = "key string, start long, n long, firing string"


BLOCK = 4_096   # windows, by their begin, whose state is kept and read as one


class PaneCounter(StatefulProcessor):
    """A block of a key's windows with their counts and the late rows since the last firing. Times are milliseconds; counts add up over firings.

    The state of a block is one value and one timer stands at what is due first in it, so a micro-batch asks the state a few times per block, not per window. Blocks of a busy key are apart.
    """

    def __init__(self, width: int, slide: int, lateness: int, late_rows: int, block: int = BLOCK) -> None:
        self.width, self.slide, self.lateness, self.late_rows, self.block = width, slide, lateness, late_rows, block

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getValueState("windows", "start array<bigint>, n array<bigint>, waiting array<bigint>, ended array<boolean>, due bigint")

    def _load(self) -> tuple[dict[int, tuple[int, int, bool]], int | None]:
        found = self.windows.get() if self.windows.exists() else None
        return ({s: (n, w, e) for s, n, w, e in zip(*found[:4])}, found[4]) if found else ({}, None)

    def _keep(self, windows: dict[int, tuple[int, int, bool]], before: int | None) -> None:
        """Store the windows and let the only timer stand at what is due first."""
        due = min((s + self.width + (self.lateness if ended else 0) for s, (_, _, ended) in windows.items()), default=None)
        if windows:
            n, waiting, ended = zip(*windows.values())
            self.windows.update((list(windows), list(n), list(waiting), list(ended), due))
        elif before is not None:
            self.windows.clear()
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
        watermark = timerValues.getCurrentWatermarkInMs()
        come: Counter = Counter()
        for frame in rows:
            for at, m in zip(frame["at"].tolist(), frame["m"].tolist()):
                come[at] += m
        low, high = key[1] * self.block * self.slide, (key[1] + 1) * self.block * self.slide - self.slide
        touched: Counter = Counter()
        for pane, m in come.items():
            for start in range(max(low, pane - self.width + self.slide), min(high, pane) + 1, self.slide):
                touched[start] += m
        windows, due = self._load()
        out, changed = [], False
        for start, m in sorted(touched.items()):
            end = start + self.width
            if end + self.lateness <= watermark:
                continue    # nothing is kept of this window any more
            n, waiting, ended = windows.get(start, (0, 0, end <= watermark))
            if end <= watermark and not ended:      # it is due in this micro-batch, after these late rows
                out.append((start, n, ON_TIME))
            n += m
            if end > watermark:
                out.append((start, n, EARLY))
            else:
                waiting += m
                if waiting >= self.late_rows:
                    out.append((start, n, LATE))
                    waiting = 0
            windows[start], changed = (n, waiting, end <= watermark), True
        if changed:
            self._keep(windows, due)
        yield from self._rows(key[0], out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
        watermark, at = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        windows, due = self._load()
        if due is None:
            return
        out = []
        for start in sorted(windows):
            n, waiting, ended = windows[start]
            end = start + self.width
            if not ended and (end < watermark or end <= at):
                out.append((start, n, ON_TIME))
                windows[start] = (n, waiting, True)
            gone = end + self.lateness
            if gone < watermark or gone <= at:
                if waiting:
                    out.append((start, n, LAST))
                del windows[start]
        self._keep(windows, due)
        yield from self._rows(key[0], out)

    @staticmethod
    def _rows(key: str | None, out: list[tuple[int, int, str]]) -> Iterator[Any]:
        import pandas as pd
        if out:
            start, n, firing = zip(*out)
            yield pd.DataFrame({"key": [key] * len(out), "start": start, "n": n, "firing": firing})

    def close(self) -> None:
        pass


def fired_counts(rows: DataFrame, ts: str, key: Column, width: int, slide: int, lateness: int, late_rows: int = 3, late: str = "0 seconds", block: int = BLOCK) -> DataFrame:
    """Stream of ``(key, w_start, w_end, n, firing)``: rows of the key in windows of ``width`` seconds that begin every ``slide`` seconds, counted so far.

    ``early``: in every micro-batch that adds to a window that has not ended; the trigger's interval is the time between early firings. ``on time``: when the watermark, ``late`` behind the newest
    row, has passed the window's end. ``late``: once ``late_rows`` more rows have come within ``lateness`` seconds after that. ``last``: when that time is over, if rows have come since the last firing.
    Rows after that are dropped. Rows are counted by pane before they are sent to their key, so a busy key is sent a few counts per task and batch.
    """
    prepare(rows.sparkSession)
    step = slide * 1_000

    def by_pane(batches):
        import pandas as pd
        for frame in batches:
            if len(frame):
                counted = frame.assign(at=frame["at"] // step * step).groupby(["key", "at"], dropna=False).size().reset_index(name="m")
                # a pane goes to every block that has windows with it
                first, last = (counted["at"] - width * 1_000 + step) // (block * step), counted["at"] // (block * step)
                for later in range(int((last - first).max()) + 1):
                    own, nr = counted[first + later <= last], first + later
                    yield pd.DataFrame({"key": own["key"], "block": nr[nr <= last], "at": own["at"], "m": own["m"]})
    # counting in the task makes the rows new ones, which carry no watermark: late ones reach the processor
    counts = rows.withWatermark(ts, late).select(key.cast("string").alias("key"), F.unix_millis(ts).alias("at")).mapInPandas(
        by_pane, "key string, block long, at long, m long")
    fired = counts.groupBy("key", "block").transformWithStateInPandas(
        PaneCounter(width * 1_000, step, lateness * 1_000, late_rows, block), _OUT, "Append", "EventTime")
    return fired.select("key", F.timestamp_millis("start").alias("w_start"), F.timestamp_millis(F.col("start") + width * 1_000).alias("w_end"), "n", "firing")
