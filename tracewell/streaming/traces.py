"""Trace assembly on a stream: spans wait in state until their trace has been idle long enough."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracewell.session import prepare

IDLE_MINUTES = 16
CLOSED, LATE, REPEATED = "closed", "late", "repeated"

_OUT = "trace_id string, outcome string, times long, session_start long, session_end long, at long, span_id string, row_key string, body string"
_NAMES = [field.split()[0] for field in _OUT.split(", ")]


def _packed(value: dict) -> bytes:
    return zlib.compress(pickle.dumps(value, pickle.HIGHEST_PROTOCOL), 1)


def _unpacked(value: bytes) -> dict:
    return pickle.loads(zlib.decompress(bytes(value)))


def _frames(rows: list[tuple]) -> Iterator[Any]:
    """Output rows as data frames, a few thousand rows each."""
    import pandas as pd
    for k in range(0, len(rows), 10_000):
        yield pd.DataFrame(rows[k:k + 10_000], columns=_NAMES, dtype=object)


def _merged(sessions: list[tuple[int, int, int]], idle: int) -> list[tuple[int, int, int]]:
    """(first, last, received) sessions in time order; two belong together if less than ``idle`` lies between them."""
    out: list[tuple[int, int, int]] = []
    for first, last, received in sorted(sessions):
        if out and first < out[-1][1] + idle:
            out[-1] = (out[-1][0], max(last, out[-1][1]), received + out[-1][2])
        else:
            out.append((first, last, received))
    return out


BUCKETS, SLICE = 256, 60_000_000     # groups of traces with a state in common, and microseconds of spans that are kept and read as one


class TraceAssembly(StatefulProcessor):
    """A bucket of traces: their spans by slices of time in a map, and their open sessions as bounds; a timer stands at the first session to close.

    Times are microseconds. A span is late if a session ending with it would have closed already; late spans are given out at once.
    A span that comes again overwrites itself, as it falls into the same slice; how often that happened is told when its session closes. The state is asked
    a few times per slice, not per span; in memory are an incoming batch of rows, one slice, and the bounds of the bucket's open sessions.
    """

    def __init__(self, idle: int) -> None:
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "slice long", "packed binary")
        self.open = handle.getValueState("open", "packed binary, due long")

    def _sessions(self) -> tuple[dict[str, list[tuple[int, int, int]]], int | None]:
        found = self.open.get() if self.open.exists() else None
        return (_unpacked(found[0]), found[1]) if found else ({}, None)

    def _keep(self, sessions: dict[str, list[tuple[int, int, int]]], before: int | None) -> None:
        """Store the sessions and let the only timer follow the first end."""
        due = min((self._closes(last) for each in sessions.values() for _, last, _ in each), default=None)
        if sessions:
            self.open.update((_packed(sessions), due))
        elif before is not None:
            self.open.clear()
        if due != before:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)

    def _closes(self, last: int) -> int:
        """The watermark in milliseconds that ends a session with this last span."""
        return -(-(last + self.idle) // 1000)

    def _slice(self, number: int) -> dict[tuple[str, int, str, str], str]:
        return _unpacked(self.spans.getValue((number,))[0]) if self.spans.containsKey((number,)) else {}

    def handleInputRows(self, key: Any, rows: Iterator[Any], timerValues: Any) -> Iterator[Any]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        arrived: dict[str, list[tuple[int, int, int]]] = {}
        for frame in rows:
            late, slices = [], {}
            for trace, span_id, row_key, at, body in zip(*[frame[c].tolist() for c in ("trace_id", "span_id", "row_key", "at", "body")]):
                if at + self.idle <= watermark:
                    late.append((trace, LATE, 1, None, None, at, span_id, row_key, body))
                    continue
                slices.setdefault(at // SLICE, {})[trace, at, span_id, row_key] = body
                arrived.setdefault(trace, []).append((at, at, 1))
            for number, come in slices.items():
                self.spans.updateValue((number,), (_packed(self._slice(number) | come),))
            arrived = {trace: _merged(each, self.idle) for trace, each in arrived.items()}
            yield from _frames(late)
        if arrived:
            sessions, before = self._sessions()
            for trace, each in arrived.items():
                sessions[trace] = _merged(sessions.get(trace, []) + each, self.idle)
            self._keep(sessions, before)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Any]:
        watermark = timerValues.getCurrentWatermarkInMs()
        sessions, before = self._sessions()
        done = {trace: ended for trace, each in sessions.items() if (ended := [s for s in each if self._closes(s[1]) <= watermark])}
        if not done:
            return
        written = {(trace, session): 0 for trace, ended in done.items() for session in ended}
        newest = max(last for _, last, _ in (s for ended in done.values() for s in ended))
        for number in sorted(n for (n,) in self.spans.keys() if n <= newest // SLICE):
            out, left = [], {}
            for (trace, at, span_id, row_key), body in self._slice(number).items():
                session = next((s for s in done.get(trace, ()) if s[0] <= at <= s[1]), None)
                if session is None:
                    left[trace, at, span_id, row_key] = body
                else:
                    written[trace, session] += 1
                    out.append((trace, CLOSED, 1, session[0], session[1], at, span_id, row_key, body))
            if out and left:
                self.spans.updateValue((number,), (_packed(left),))
            elif out:
                self.spans.removeKey((number,))
            yield from _frames(out)
        still = {trace: left for trace, each in sessions.items() if (left := [s for s in each if (trace, s) not in written])}
        self._keep(still, before)
        yield from _frames([(trace, REPEATED, received - n, first, last, None, None, None, None)
                            for (trace, (first, last, received)), n in written.items() if received > n])

    def close(self) -> None:
        pass


def assemble(spans: DataFrame, late: str = "16 minutes", idle_minutes: int = IDLE_MINUTES) -> DataFrame:
    """Stream of what became of each span: ``outcome``, ``times``, ``session_start``, ``session_end`` and the span's columns.

    ``closed``: a span of a trace that has been idle for ``idle_minutes`` since its last span, by a watermark that lies ``late`` behind the newest
    span; a trace id that comes up again later is another session. ``late``: a span whose session could only be one that has closed; it has no session.
    ``repeated``: no span, but how often spans of a closed session came again. ``times`` adds up to the spans received, once all sessions have closed. Spans need
    ``trace_id``, ``span_id``, ``row_key`` and ``ts``; those without trace or time are of no trace and left out. Traces share the state of their bucket in the
    state store, which is disk-backed, and sessions are given out slice by slice: a busy trace keeps one task busy, and its spans of a minute must fit into memory.
    """
    prepare(spans.sparkSession)
    keys = ("trace_id", "span_id", "row_key", "ts")
    rest = [f for f in spans.schema if f.name not in keys]
    # the watermark goes with ts, which late spans must not carry into the processor: there they would be dropped unseen
    waiting = spans.where("trace_id IS NOT NULL AND ts IS NOT NULL").withWatermark("ts", late).select(
        "trace_id", "span_id", "row_key", F.unix_micros("ts").alias("at"), F.to_json(F.struct(*[f.name for f in rest])).alias("body"))
    bucket = F.pmod(F.xxhash64("trace_id"), F.lit(BUCKETS))
    found = waiting.withColumn("bucket", bucket).groupBy("bucket").transformWithStateInPandas(TraceAssembly(idle_minutes * 60_000_000), _OUT, "Append", "EventTime")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    moment = lambda name: F.timestamp_micros(name)
    opened = found.withColumn("_b", F.from_json("body", schema))
    return opened.select("outcome", "times", moment("session_start").alias("session_start"), moment("session_end").alias("session_end"),
                         "trace_id", "span_id", "row_key", moment("at").alias("ts"), *[F.col(f"_b.{f.name}").alias(f.name) for f in rest])
