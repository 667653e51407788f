"""Running summaries that micro-batches add to: endpoint moments, decaying rates, and interval histograms that come out when their interval ends.

State is a table below a folder, one version per micro-batch, so that a repeated batch starts from what its first run started from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tracewell.functions.scale import lookup
from tracewell.operators import metrics, outliers, snapshots
from tracewell.session import _delete, discard, stage, versions
from tracewell.sinks.writers import BatchWriter


def keep_traces(state: str, out: BatchWriter, threshold: float = 0.7, daily: bool = False) -> BatchWriter:
    """Micro-batch writer that hands on the kept traces of normalised spans, which must come in time order between batches.

    ``state`` holds each endpoint's moments after each batch. A batch works like the batch operator, on slices of endpoints in time order, with the
    stored moments before the first slice: neither its spans nor its state gather a busy endpoint in one task.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        spans = stage(batch, "spans")
        earlier = [v for v in versions(spark, state) if v < batch_id]
        before = spark.read.parquet(f"{state}/batch={earlier[-1]}") if earlier else None
        out(outliers.kept_traces(spans, threshold, daily, before=before), batch_id)
        source, keys = outliers.by_endpoint(spans, daily)
        now = outliers.moments(source, keys)
        now = now if before is None else outliers.merge_moments(now.unionByName(before), keys)
        now.write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        for old in earlier[:-1]:
            _delete(spark, f"{state}/batch={old}")
        discard(spans)
    return write


def closed_histograms(rows: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int = 900, late: str = "0 seconds") -> DataFrame:
    """Stream of ``interval_histograms``: an interval comes out once, when the watermark, ``late`` behind the newest row, has passed its end; its state is gone then."""
    window = F.window(ts, f"{seconds} seconds")
    counted = rows.withWatermark(ts, late).groupBy(window, *keys, F.col(value).cast("long").alias("value")).agg(F.count("*").alias("count"))
    return counted.select(*keys, F.col("window.start").alias("w"), "value", "count")


def snapshot_writer(history: str, out: BatchWriter, keys: Sequence[str], probs: Sequence[float]) -> BatchWriter:
    """Micro-batch writer of closed histograms: stores them below ``history`` by day, and hands on the snapshots of the intervals that have come.

    Only the days of these intervals are read back. Intervals must come in time order between batches, as those of one watermark do.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        come = stage(batch.withColumn("day", F.to_date("w")), "intervals")
        days = [r["day"] for r in come.select("day").distinct().collect()]      # a micro-batch spans a few days
        if not days:
            return
        earlier = [v for v in versions(spark, history) if v < batch_id]
        hist = come
        if earlier:
            stored = spark.read.option("basePath", history).parquet(*[f"{history}/batch={v}" for v in earlier]).drop("batch")
            hist = come.unionByName(stored.where(F.col("day").isin(days)))
        come.write.mode("overwrite").partitionBy("day").parquet(f"{history}/batch={batch_id}")
        out(snapshots.day_to_date(hist.drop("day"), keys, probs, come.select("w")), batch_id)
        discard(come)
    return write


def _advanced(ticks: DataFrame, keys: Sequence[str], minutes: Sequence[int]) -> DataFrame:
    """One row per key from rows of ticks and of earlier states: newest tick, its count, and the decayed rates of the ticks before it.

    A row is the count ``_n`` of tick ``_k`` with the rates ``_p<m>`` that held when the tick began; a tick alone has rates 0. A
    rate loses the same share with every tick, so rows add up in any order once each is brought forward to the newest tick.
    """
    newest = ticks.groupBy(*keys).agg(F.max("_k").alias("_r"), F.min("_t0").alias("_t0"), F.sum("_total").alias("_total"))
    age = F.col("_r") - F.col("_k")
    sums = []
    for m in minutes:
        a = metrics.decay(m)
        weight = F.when(F.col("_k") == 0, 1.0).otherwise(a) / metrics.TICK
        counted = F.when(age > 0, weight * F.col("_n") * F.pow(F.lit(1 - a), age - 1)).otherwise(0.0)
        sums.append(F.sum(F.col(f"_p{m}") * F.pow(F.lit(1 - a), age) + counted).alias(f"_p{m}"))
    rows = lookup(ticks.drop("_t0", "_total"), newest, keys, "inner")
    return rows.groupBy(*keys, "_t0", F.col("_r").alias("_k"), "_total").agg(F.sum(F.when(age == 0, F.col("_n")).otherwise(0)).alias("_n"), *sums)


def _reported(state: DataFrame, keys: Sequence[str], end: Column, minutes: Sequence[int]) -> DataFrame:
    """The columns of ``metrics.rates`` at the report time ``end``, from the state of each key."""
    elapsed = F.unix_micros(end) - F.unix_micros("_t0")
    idle = F.floor(elapsed / F.lit(metrics.TICK * 1_000_000)) - 1 - F.col("_k")   # complete ticks after the newest one; -1: that one is not complete
    moving = []
    for m in minutes:
        a, before = metrics.decay(m), F.col(f"_p{m}")
        weight = F.when(F.col("_k") == 0, 1.0).otherwise(a) / metrics.TICK
        moving.append(F.when(idle < 0, before).otherwise((before * (1 - a) + weight * F.col("_n")) * F.pow(F.lit(1 - a), idle)).alias(f"m{m}_rate"))
    mean = F.when(elapsed > 0, F.col("_total") * 1e6 / elapsed).otherwise(0.0)
    return state.select(*keys, F.col("_total").alias("total"), mean.alias("mean_rate"), *moving)


def rate_writer(state: str, out: BatchWriter, keys: Sequence[str], ts: str, end: Column, late: int = 0, minutes: Sequence[int] = (1, 5, 15)) -> BatchWriter:
    """Micro-batch writer of ``metrics.rates``: a key comes out once, when rows ``late`` seconds newer than its report time ``end`` have been seen.

    ``state`` holds for each open key its newest tick and one decayed number per rate, whatever its number of rows or ticks. Rows may come out of order within
    ``late`` seconds; one that is older than the first row seen of its key counts to that row's tick, and a row of a key that has come out is dropped.
    Rows must be older than the report time of their key. A repeated batch starts from the state before its first run.
    """
    keys = list(keys)
    rates = [f"_p{m}" for m in minutes]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = stage(batch.groupBy(*keys, F.col(ts).alias("_t")).agg(F.count("*").alias("_m")), "times")
        earlier = [v for v in versions(spark, state) if v < batch_id]
        before = spark.read.parquet(f"{state}/batch={earlier[-1]}") if earlier else None
        was = before.agg(F.max("_seen").alias("seen")).first()["seen"] if earlier else None
        now = rows.agg(F.max(F.unix_micros("_t")).alias("seen")).first()["seen"]
        seen = max((x for x in (was, now) if x is not None), default=None)
        if seen is None:
            return
        source = rows if was is None else rows.where(F.unix_micros(end) > was - late * 1_000_000)
        firsts = source.select(*keys, F.col("_t").alias("_t0"))
        stored = None if before is None else before.where("_k IS NOT NULL").drop("_seen")
        if stored is not None:
            known = stored.select(*keys, F.col("_t0").alias("_known"))
            firsts = lookup(firsts, known, keys).select(*keys, F.coalesce("_known", "_t0").alias("_t0"))
        firsts = firsts.groupBy(*keys).agg(F.min("_t0").alias("_t0"))
        number = F.floor((F.unix_micros("_t") - F.unix_micros("_t0")) / F.lit(metrics.TICK * 1_000_000))
        ticks = lookup(source, firsts, keys, "inner").withColumn("_k", F.greatest(number, F.lit(0))).groupBy(*keys, "_t0", "_k").agg(F.sum("_m").alias("_n"))
        ticks = ticks.select("*", F.col("_n").alias("_total"), *[F.lit(0.0).alias(r) for r in rates])
        current = stage(_advanced(ticks if stored is None else ticks.unionByName(stored), keys, minutes), "rates")
        closed = F.unix_micros(end) <= seen - late * 1_000_000
        out(_reported(current.where(closed), keys, end, minutes), batch_id)
        # a row without a key's values carries the newest time on when no key is open
        kept = current.where(~closed).withColumn("_seen", F.lit(seen))
        mark = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "_seen" else F.lit(seen).alias("_seen") for f in kept.schema])
        kept.unionByName(mark).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
        for old in earlier[:-1]:
            _delete(spark, f"{state}/batch={old}")
        discard(rows, current)
    return write
