"""Slow- and failed-span detection and the table of kept traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewell.functions import expressions as E
from tracewell.functions.scale import lookup, ordered_slices, slice_prefix

KEPT_KEYS = ["trace_id", "type", "app", "span_id"]


def _kept_app() -> Column:
    return F.when(F.col("metric_kind").isNull(), F.col("app")).otherwise(
        F.concat("app", F.lit(E.SEPARATOR), "metric_kind"))


EXACT = "decimal(38,0)"
ENDPOINT = ["app", "metric_kind", "name"]


def moments(spans: DataFrame, keys: Sequence[str], value: str = "duration") -> DataFrame:
    """(keys, n, s, q, lo, hi): count, sum, sum of squares and bounds of each key's values, in exact numbers, so that parts add up in any order."""
    v = F.col(value).cast(EXACT)
    return spans.groupBy(*keys).agg(
        F.count(value).alias("n"), F.sum(v).cast(EXACT).alias("s"), F.sum((v * v).cast(EXACT)).cast(EXACT).alias("q"),
        F.min(value).alias("lo"), F.max(value).alias("hi"))


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Moments of several parts as one row per key."""
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("s").cast(EXACT).alias("s"), F.sum("q").cast(EXACT).alias("q"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def running_distribution(spans: DataFrame, keys: Sequence[str], order: Sequence[str],
                         value: str = "duration", slices: int | None = None, before: DataFrame | None = None) -> DataFrame:
    """Mean and deviation of each span's endpoint up to and including that span.

    Endpoints are cut into time-ordered slices. Slice totals give what came before a slice; the rest
    is a window inside the slice, so one busy endpoint is worked on by many tasks. Values are taken
    relative to the endpoint's overall mean, which keeps the squares small. ``before`` holds the moments of spans that came before all of these.
    """
    keys = list(keys)
    exact = EXACT
    cut = ordered_slices(spans, keys, order, slices)
    totals = moments(cut, [*keys, "_slice"], value)
    whole = Window.partitionBy(*keys)
    pivot = F.round(F.sum("s").over(whole) / F.sum("n").over(whole)).cast("long")
    prefix = slice_prefix(totals, keys, ["n", "s", "q"], ["lo"], ["hi"])
    if before is not None:
        earlier = before.select(*keys, *[F.col(c).alias(f"_{c}") for c in ("n", "s", "q", "lo", "hi")])
        prefix = lookup(prefix, earlier, keys).withColumns({
            **{f"before_{c}": (F.col(f"before_{c}") + F.coalesce(f"_{c}", F.lit(0))).cast(exact if c != "n" else "long") for c in ("n", "s", "q")},
            "before_lo": F.least("before_lo", "_lo"), "before_hi": F.greatest("before_hi", "_hi")}).drop("_n", "_s", "_q", "_lo", "_hi")
    pivots = totals.withColumn("_pivot", pivot).select(*keys, "_slice", "_pivot")

    def null_safe(left: str, right: str) -> list[Column]:
        return [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in [*keys, "_slice"]]

    side = prefix.alias("a").join(pivots.alias("b"), null_safe("a", "b")).select("a.*", "b._pivot")
    rows = cut.alias("c").join(side.alias("d"), null_safe("c", "d")).select(
        "c.*", "d.before_n", "d.before_s", "d.before_q", "d.before_lo", "d.before_hi", "d._pivot")
    upto = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = (F.col(value) - F.col("_pivot")).cast("double")
    n = F.col("before_n") + F.count(value).over(upto)
    p, s0, q0 = F.col("_pivot").cast("double"), F.col("before_s").cast("double"), F.col("before_q").cast("double")
    before = F.col("before_n").cast("double")
    total = (s0 - before * p) + F.sum(d).over(upto)
    squares = (q0 - 2 * p * s0 + before * p * p) + F.sum(d * d).over(upto)
    shifted = total / n
    seen = (F.col("before_s") + F.sum(value).over(upto)).cast(exact)
    lowest = F.least(F.col("before_lo"), F.min(value).over(upto))
    highest = F.greatest(F.col("before_hi"), F.max(value).over(upto))
    return rows.withColumns({
        "run_n": n,
        "run_total": seen,
        "run_mean": seen.cast("double") / n,
        "run_sd": F.when(lowest == highest, 0.0).otherwise(
            F.sqrt(F.greatest(squares / n - shifted * shifted, F.lit(0.0)))),
    }).drop("before_n", "before_s", "before_q", "before_lo", "before_hi", "_pivot", "_slice")


def by_endpoint(spans: DataFrame, daily: bool) -> tuple[DataFrame, list[str]]:
    """Spans with the keys of their endpoint's distribution, which may start anew each day."""
    return (spans.withColumn("_day", F.to_date("ts")), [*ENDPOINT, "_day"]) if daily else (spans, ENDPOINT)


def slow_spans(spans: DataFrame, threshold: float = 0.7, daily: bool = False,
               slices: int | None = None, before: DataFrame | None = None) -> DataFrame:
    """Spans above their endpoint's running mean whose ``(duration - sd) / sd`` exceeds ``threshold``; ``before`` as in ``running_distribution``."""
    source, keys = by_endpoint(spans, daily)
    known = running_distribution(source, keys, ["ts", "trace_id", "span_id", "row_key"], slices=slices, before=before)
    sd = F.col("run_sd")
    return known.where((F.col("duration") > F.col("run_mean")) & (sd > 0)
                       & ((F.col("duration") - sd) / sd > threshold)).drop("_day")


def failed_spans(spans: DataFrame) -> DataFrame:
    return spans.where(E.is_failed(E.tag(E.TAG_ERROR)))


def kept_traces(spans: DataFrame, threshold: float = 0.7, daily: bool = False, before: DataFrame | None = None) -> DataFrame:
    """Failed spans (ERROR) and slow spans (COST) as kept-trace rows; ``before`` as in ``running_distribution``."""
    def hits(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(
            _kept_app().alias("app"), F.lit(kind).alias("type"), "trace_id", "span_id", "row_key",
            F.col("name").alias("span_name"), "duration",
            F.timestamp_millis(F.floor(F.unix_micros("ts") / 1000)).alias("create_time"))
    # slices are written down: with the columns that hits have, and no others
    timed = spans.select("trace_id", "span_id", "row_key", "name", "duration", "ts", "app", "metric_kind")
    return hits(failed_spans(spans), "ERROR").unionByName(hits(slow_spans(timed, threshold, daily, before=before), "COST"))


def insert_absent(new: DataFrame, existing: DataFrame | None, keys: Sequence[str] = KEPT_KEYS,
                  order: Sequence[str] = ("create_time", "row_key")) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet, the earliest per key."""
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    unique = first.select(*keys, "_r.*").select(*new.columns)
    if existing is None:
        return unique
    on = [F.col(f"n.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return unique.alias("n").join(existing.select(*keys).alias("s"), on, "left_anti")
