"""Alarm rules on a stream: hits are matched micro-batch by micro-batch, rules run by event-time timers.

``match_writer`` turns hits into counts per rule and second, as files; ``run_rules`` reads these, and changes of rules, as one stream. A rule's state is its schedule, its
throttle window and the counts that its next runs will see: never hits, so a rule that most hits satisfy costs no more than others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracewell.operators import alarms
from tracewell.session import prepare
from tracewell.sinks.writers import BatchWriter

RULE, HITS, BEAT = "rule", "hits", "beat"
EVENT = "rule_id long, kind string, at timestamp, n long, enable boolean, frequency long, throttle long, threshold long"
_OUT = "rule_id long, tick long, matches long, fired boolean"
_Out = Row("rule_id", "tick", "matches", "fired")


def rule_changes(rules: DataFrame, at: str) -> DataFrame:
    """Rules as events: what they are from the time ``at`` on."""
    return rules.select(F.col("id").cast("long").alias("rule_id"), F.lit(RULE).alias("kind"), F.col(at).cast("timestamp").alias("at") if at in rules.columns
                        else F.lit(at).cast("timestamp").alias("at"), F.lit(None).cast("long").alias("n"),
                        F.coalesce("enable", F.lit(False)).cast("boolean").alias("enable"),
                        *[F.col(c).cast("long").alias(c) for c in ("frequency", "throttle", "threshold")])


def matched(hits: DataFrame, rules: DataFrame) -> DataFrame:
    """Hits as events: how many hits each rule has in each second, and one beat that says how far time has come."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("enable", "boolean"), ("frequency", "long"), ("throttle", "long"), ("threshold", "long"))]
    counted = alarms.matching(hits, rules).groupBy("rule_id", F.timestamp_seconds(F.unix_seconds("create_time")).alias("at")).agg(F.count("*").alias("n"))
    beat = hits.agg(F.max("create_time").alias("at")).where("at IS NOT NULL")
    return counted.select(F.col("rule_id").cast("long").alias("rule_id"), F.lit(HITS).alias("kind"), "at", "n", *none).unionByName(
        beat.select(F.lit(None).cast("long").alias("rule_id"), F.lit(BEAT).alias("kind"), "at", F.lit(None).cast("long").alias("n"), *none))


def match_writer(rules: Callable[[int], DataFrame], out: BatchWriter) -> BatchWriter:
    """Micro-batch writer of hits as events; ``rules`` gives the rules as they are for a micro-batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out(matched(batch, rules(batch_id)), batch_id)
    return write


class RuleClock(StatefulProcessor):
    """One rule: runs at every due tick by which it has hits, and fires by its throttle window. Times are whole seconds."""

    def __init__(self, tick: int) -> None:
        self.tick = tick

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rule = handle.getValueState("rule", "origin long, frequency long, throttle long, threshold long")
        self.counts = handle.getMapState("counts", "at long", "n long")
        self.window = handle.getValueState("window", "opened long, n long")
        self.due = handle.getValueState("due", "at long")

    def _forget(self) -> None:
        if self.due.exists():
            self.handle.deleteTimer(self.due.get()[0] * 1000)
        for state in (self.rule, self.counts, self.window, self.due):
            state.clear()

    def _wait(self, at: int | None) -> None:
        """Let the only timer stand at ``at``."""
        before = self.due.get()[0] if self.due.exists() else None
        if before == at:
            return
        if before is not None:
            self.handle.deleteTimer(before * 1000)
        if at is None:
            self.due.clear()
        else:
            self.due.update((at,))
            self.handle.registerTimer(at * 1000)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if key[0] is None:      # beats only move the watermark
            return
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        yield from self._run(key[0], passed)       # what these rows change comes after the runs that are due
        rule = self.rule.get() if self.rule.exists() else None
        due = self.due.get()[0] if self.due.exists() else None
        for row in sorted(rows, key=lambda r: (r.at, r.kind == HITS)):
            if row.kind == RULE:
                if not row.enable:
                    self._forget()
                    rule = due = None
                    continue
                # a rule that was off starts anew; another frequency has another schedule
                origin = rule[0] if rule is not None and rule[1] == row.frequency else row.at
                rule = (origin, row.frequency, row.throttle, row.threshold)
                self.rule.update(rule)
            elif row.kind == HITS and rule is not None:
                first = self._next(rule, max(row.at, passed + 1 if passed > 0 else row.at))
                if first <= row.at + rule[1]:       # else no run is left that would see them
                    known = self.counts.getValue((row.at,)) if self.counts.containsKey((row.at,)) else (0,)
                    self.counts.updateValue((row.at,), (known[0] + row.n,))
                    due = first if due is None else min(due, first)
        if rule is not None:
            self._wait(due)

    def _next(self, rule: tuple, at: int) -> int:
        """The rule's first run at ``at`` or later."""
        period = -(-rule[1] // self.tick) * self.tick
        return rule[0] + -(-(at - rule[0]) // period) * period

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        yield from self._run(key[0], timerValues.getCurrentWatermarkInMs() // 1000)

    def _run(self, rule_id: int, passed: int) -> Iterator[Row]:
        """All runs that are due by the time ``passed``."""
        tick = self.due.get()[0] if self.due.exists() else None
        if tick is None or tick > passed:
            return
        rule = self.rule.get()
        frequency, throttle, threshold = rule[1:]
        counts = {at: n for (at,), (n,) in self.counts.iterator()}
        opened, times = self.window.get() if self.window.exists() else (None, 0)
        while tick is not None and tick <= passed:
            matches = sum(n for at, n in counts.items() if tick - frequency <= at <= tick)
            if matches:
                if opened is None or tick - opened >= throttle:
                    opened, times, fire = tick, 1, False
                else:
                    fire, times = threshold <= times, times + 1
                yield _Out(rule_id, tick, matches, fire)
            following = self._next(rule, tick + 1)
            ahead = [run for at in counts if (run := max(self._next(rule, at), following)) <= at + frequency]
            tick = min(ahead, default=None)
        after = tick if tick is not None else passed + 1
        for at in [at for at in counts if self._next(rule, max(at, after)) > at + frequency]:
            self.counts.removeKey((at,))
        if opened is not None:
            self.window.update((opened, times))
        self._wait(tick)

    def close(self) -> None:
        pass


def run_rules(events: DataFrame, tick: int = 60, late: str = "0 seconds") -> DataFrame:
    """Stream of ``(rule_id, tick, matches, fired)`` from a stream of rule and hit events (columns as in ``EVENT``).

    A rule runs every ``frequency`` seconds, rounded up to whole ticks, from the time it was last switched on; a run sees the hits of the last ``frequency`` seconds.
    It takes place once the watermark, ``late`` behind the newest event, has passed its time, so the order of events within that does not matter. Runs without
    hits give nothing. A rule that is switched off forgets its schedule, its throttle window and its hits.
    """
    prepare(events.sparkSession)
    waiting = events.withWatermark("at", late).select(
        "rule_id", "kind", F.unix_seconds("at").alias("at"), "n", "enable", "frequency", "throttle", "threshold")
    return waiting.groupBy("rule_id").transformWithState(RuleClock(tick), _OUT, "Append", "EventTime")
