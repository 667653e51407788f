"""Counts, rates, latency summaries and the per-endpoint metric row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tracewell.functions import expressions as E
from tracewell.functions.scale import distribution, lookup, probability_name

PERCENTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)
TICK = 5  # seconds between rate updates


def counts(df: DataFrame, keys: Sequence[str | Column], name: str = "total",
           where: Column | None = None) -> DataFrame:
    """Rows per key, optionally of the rows matching a condition only."""
    source = df if where is None else df.where(where)
    return source.groupBy(*keys).agg(F.count("*").alias(name))


def latency(df: DataFrame, keys: Sequence[str], value: str, positive_only: bool = False,
            probs: Sequence[float] = PERCENTILES, width: int = 10_000) -> DataFrame:
    """Exact latency summary per key: n, min, max, mean, stddev and percentiles."""
    source = df.where(F.col(value) > 0) if positive_only else df
    return distribution(source, keys, value, probs, width)


def latency_approx(df: DataFrame, keys: Sequence[str], value: str,
                   probs: Sequence[float] = PERCENTILES, accuracy: int = 10_000) -> DataFrame:
    """Single-pass latency summary with approximate percentiles."""
    marks = F.percentile_approx(value, list(probs), accuracy)
    summary = df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.avg(value).alias("mean"), F.stddev_pop(value).alias("stddev"), marks.alias("_p"))
    names = [probability_name(p) for p in probs]
    return summary.select("*", *[F.col("_p")[i].alias(n) for i, n in enumerate(names)]).drop("_p")


def decay(minutes: int) -> float:
    return 1 - math.exp(-TICK / (60.0 * minutes))


def rates(df: DataFrame, keys: Sequence[str], ts: str, end: Column, minutes: Sequence[int] = (1, 5, 15),
          weight: str | None = None) -> DataFrame:
    """Mean rate and moving rates per key up to the report time ``end`` (an expression over the keys).

    Ticks of five seconds run from the key's first event. Only ticks complete at ``end`` count; the
    first one seeds the average, each later one decays it. Rows are reduced to counts per key and time once; both
    the first event and the ticks come from these.
    """
    keys = list(keys)
    amount = F.count("*") if weight is None else F.sum(weight)
    moments = df.groupBy(*keys, F.col(ts).alias("_t")).agg(amount.alias("_m"))
    first = moments.groupBy(*keys).agg(F.min("_t").alias("_t0"))
    ticks = (lookup(moments, first, keys, "inner")
             .withColumn("_k", F.floor((F.unix_micros("_t") - F.unix_micros("_t0")) / F.lit(TICK * 1_000_000)))
             .groupBy(*keys, "_t0", "_k").agg(F.sum("_m").alias("_n")))
    elapsed = F.unix_micros(end) - F.unix_micros("_t0")
    ticks = ticks.withColumn("_ticks", F.floor(elapsed / F.lit(TICK * 1_000_000)))
    n, k = F.col("_ticks"), F.col("_k")
    per_second = F.col("_n") / F.lit(float(TICK))
    moving = []
    for m in minutes:
        a = decay(m)
        share = F.when(k == 0, F.pow(F.lit(1 - a), n - 1)).otherwise(F.lit(a) * F.pow(F.lit(1 - a), n - 1 - k))
        moving.append(F.coalesce(F.sum(F.when(k < n, share * per_second)), F.lit(0.0)).alias(f"m{m}_rate"))
    return ticks.withColumn("_elapsed", elapsed).groupBy(*keys).agg(
        F.sum("_n").alias("total"),
        (F.when(F.max("_elapsed") > 0, F.sum("_n") * 1e6 / F.max("_elapsed")).otherwise(0.0)).alias("mean_rate"),
        *moving)


def endpoint_metrics(spans: DataFrame, keys: Sequence[str], interval_end: Column | None = None) -> DataFrame:
    """One metric row per key: totals, 15-minute rate at ``interval_end``, latency summary, failures and failure rate.

    Counts, failures and latency come out of one histogram pass.
    """
    keys = list(keys)
    failed = E.is_failed(E.tag(E.TAG_ERROR)).cast("long")
    base = distribution(spans, keys, "duration", (0.95, 0.99), sums={"errors": failed})
    shaped = base.select(
        *keys, F.col("rows").alias("total"), F.col("mean").alias("cost"), F.col("p99").alias("cost_tp99"),
        F.col("p95").alias("cost_tp95"), F.col("max").alias("cost_max"), "errors",
        E.error_rate(F.col("errors"), F.col("rows")).alias("error_rate"))
    if interval_end is None:
        return shaped
    moving = rates(spans, keys, "ts", interval_end, (15,)).select(*keys, F.col("m15_rate").alias("qps"))
    on = [F.col(f"b.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return shaped.alias("b").join(moving.alias("r"), on, "left").select("b.*", "r.qps")


def _living_largest(steps: Column, ttl: int) -> Column:
    """``(t, v)`` steps in time order with the largest v that still lives at each; see ``largest_alive``."""
    start = F.struct(F.lit(None).cast("double").alias("best"), F.lit(None).cast("long").alias("since"),
                     F.array().cast("array<struct<t:bigint,v_max:double>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        anew = state["best"].isNull() | (x["t"] >= state["since"] + ttl) | (x["v"] > state["best"])
        best, since = F.when(anew, x["v"]).otherwise(state["best"]), F.when(anew, x["t"]).otherwise(state["since"])
        return F.struct(best.alias("best"), since.alias("since"),
                        F.array_append(state["out"], F.struct(x["t"].alias("t"), best.alias("v_max"))).alias("out"))
    return F.aggregate(steps, start, step, lambda state: state["out"])


def largest_alive(df: DataFrame, keys: Sequence[str], t: str, v: str, ttl: int) -> DataFrame:
    """``(keys, t, v, v_max)``: per key the largest value with a time to live of ``ttl`` seconds, renewed only by a larger value.

    Meant for per-interval metrics: a key has one row per interval, and times are whole seconds.
    """
    steps = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(t).cast("long").alias("t"), F.col(v).cast("double").alias("v")))).alias("_steps"))
    both = steps.select(*keys, F.arrays_zip("_steps", _living_largest(F.col("_steps"), ttl).alias("_best")).alias("_z"))
    return both.select(*keys, F.explode("_z").alias("_z")).select(
        *keys, F.col("_z._steps.t").alias("t"), F.col("_z._steps.v").alias("v"), F.col("_z._best.v_max").alias("v_max"))


def with_largest_rate(rows: DataFrame, keys: Sequence[str], at: str, ttl: int) -> DataFrame:
    """Interval metric rows with ``qps_max``, the largest rate of their key that still lives."""
    best = largest_alive(rows.withColumn("_t", F.unix_seconds(at)), keys, "_t", "qps", ttl).select(
        *keys, F.timestamp_seconds("t").alias(at), F.col("v_max").alias("qps_max"))
    return lookup(rows, best, [*keys, at])


def report_rows(metric: DataFrame, name: Column, kind: str, values: Sequence[str], host: str,
                at: Column) -> DataFrame:
    """Flat report rows ``(name, type, field, value, host, report_time)`` from a wide metric table."""
    wide = metric.select(name.alias("name"), F.lit(kind).alias("type"),
                         *[F.col(v).cast("double").alias(v) for v in values],
                         F.lit(host).alias("host"), at.alias("report_time"))
    return wide.unpivot(["name", "type", "host", "report_time"], list(values), "field", "value")
