"""Alarm throttling as a stateful stream step."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracewell.session import prepare

class AlarmThrottle(StatefulProcessor):
    """Opens a window per rule on its first match; later matches fire once the threshold is reached."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.window = handle.getValueState("window", "opened long, n long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        opened, n = self.window.get() if self.window.exists() else (None, 0)
        for row in sorted(rows, key=lambda r: r.tick):
            if opened is None or row.tick - opened >= row.throttle:
                opened, n, fire = row.tick, 1, False
            else:
                fire, n = row.threshold <= n, n + 1
            yield Row(rule_id=key[0], tick=row.tick, matches=row.matches, fired=bool(fire))
        if opened is not None:
            self.window.update((opened, n))

    def close(self) -> None:
        pass


def throttle_stream(matches: DataFrame) -> DataFrame:
    """Streaming form of the alarm throttle over ``(rule_id, tick, matches, throttle, threshold)`` rows.

    A rule has one row per evaluation time; evaluation times must arrive in order between batches.
    """
    prepare(matches.sparkSession)
    return matches.groupBy("rule_id").transformWithState(
        AlarmThrottle(), "rule_id long, tick long, matches long, fired boolean", "update", "None")
