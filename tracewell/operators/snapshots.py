"""Interval snapshots: counts that start anew with each interval, latency of the day up to its end.

Rows become one histogram per interval. Histograms add up, so they may come from micro-batches as well. A fold over a day's intervals then gives what each
interval's end has seen, from the histograms of the intervals alone: nothing is copied into later intervals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tracewell.functions import expressions as E
from tracewell.functions.scale import lookup, probability_name

GROUPS = 4     # groups of keys folded in one call, for each shuffle partition
SUB_CELLS = 5  # bits of a value, after its first one, that its cell keeps: cells are at most 1/32 as wide as their values are large


def interval_histograms(rows: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int = 900) -> DataFrame:
    """(keys, w, value, count): how often each whole number occurs in each interval."""
    return rows.groupBy(*keys, E.bucket_start(F.col(ts), seconds).alias("w"), F.col(value).cast("long").alias("value")).agg(F.count("*").alias("count"))


def cell(value: Column) -> Column:
    """Number of the value's cell: ascending in the value, and at most a few thousand different ones."""
    size = F.abs(value)
    shift = F.greatest(F.length(F.bin(size)) - (SUB_CELLS + 1), F.lit(0)).cast("int")
    number = shift * (1 << SUB_CELLS) + F.call_function("shiftright", size, shift)
    return F.when(value >= 0, number).otherwise(-number - 1).cast("long")


def _numbered(keys: list[str], *frames: pd.DataFrame) -> list[np.ndarray]:
    """For each frame's rows the number of their key, the same in all frames."""
    every = pd.concat([f[keys] for f in frames], ignore_index=True)
    number = every.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    return np.split(number, np.cumsum([len(f) for f in frames])[:-1])


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the stretches of equal rows in sorted columns."""
    new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]) if len(columns[0]) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], len(columns[0])]))


def _until_cells(keys: list[str], probs: Sequence[float]):
    """For some keys, per interval of a key's day: summary of all cells so far, and the cells that hold the wanted ranks."""
    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        key, = _numbered([*keys, "_day"], frame)
        order = np.lexsort((frame["cell"], frame["w"], key))
        frame, key = frame.iloc[order].reset_index(drop=True), key[order]
        cell_of, w, many, low, high = (frame[c].to_numpy() for c in ("cell", "w", "n", "low", "high"))
        sums = [int(x) for x in frame["s"]]
        at, rows = [], []
        for a, b in _runs(key):
            cells, place = np.unique(cell_of[a:b], return_inverse=True)
            seen, total, n, least, most = np.zeros(len(cells), dtype=np.int64), 0, 0, None, None
            for i, j in _runs(w[a:b]):
                seen[place[i:j]] += many[a + i:a + j]      # a cell stands once in an interval
                n, total = n + int(many[a + i:a + j].sum()), total + sum(sums[a + i:a + j])
                here = int(low[a + i:a + j].min()), int(high[a + i:a + j].max())
                least, most = (here[0] if least is None else min(least, here[0])), (here[1] if most is None else max(most, here[1]))
                if not n:
                    continue
                ends = np.cumsum(seen)
                ranks = np.array([f(p * (n - 1)) for p in probs for f in (np.floor, np.ceil)], dtype=np.int64)
                found = np.searchsorted(ends, ranks, side="right")
                at.append(a + i)
                rows.append((n, least, most, total / n, cells[found], ranks - (ends[found] - seen[found])))
        made = pd.DataFrame(rows, columns=["n", "min", "max", "mean", "cells", "ranks"])
        return pd.concat([frame[[*keys, "_day", "w"]].iloc[at].reset_index(drop=True), made], axis=1)
    return fold


def _until_values(keys: list[str]):
    """For some keys, the values at the wanted ranks of a cell, as it was at the end of each interval that asks."""
    def fold(values: pd.DataFrame, wants: pd.DataFrame) -> pd.DataFrame:
        cell_v, cell_w = _numbered([*keys, "_day", "cell"], values, wants)
        order = np.lexsort((values["w"], cell_v))
        cell_v, w, value, many = cell_v[order], *(values[c].to_numpy()[order] for c in ("w", "value", "count"))
        order = np.lexsort((wants["w"], cell_w))
        wants, cell_w = wants.iloc[order].reset_index(drop=True), cell_w[order]
        asked, rank, found = wants["w"].to_numpy(), wants["rank"].to_numpy(), np.zeros(len(wants), dtype=np.int64)
        bounds = {int(cell_v[a]): (a, b) for a, b in _runs(cell_v)}
        for c, d in _runs(cell_w):
            a, b = bounds[int(cell_w[c])]
            different, place = np.unique(value[a:b], return_inverse=True)
            seen, done = np.zeros(len(different), dtype=np.int64), 0
            for i, j in _runs(asked[c:d]):
                upto = int(np.searchsorted(w[a:b], asked[c + i], side="right"))
                np.add.at(seen, place[done:upto], many[a + done:a + upto])
                done = upto
                found[c + i:c + j] = different[np.searchsorted(np.cumsum(seen), rank[c + i:c + j], side="right")]
        return wants[[*keys, "_day", "w", "slot"]].assign(found=found)
    return fold


def _types(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def day_to_date(hist: DataFrame, keys: Sequence[str], probs: Sequence[float], wanted: DataFrame | None = None) -> DataFrame:
    """(keys, w, total, n, min, max, mean, percentiles): an interval's own count, and the exact latency summary of its day up to its end.

    ``hist`` is made by ``interval_histograms``; null values count in ``total`` only, and a key without any value so far has no summary. ``wanted`` names the intervals (column w) to give out, by default all in which
    a key was active. A key's day is folded from its cells: at most intervals x cells rows, whatever the number of requests; then a cell that holds a wanted rank is folded from its
    different values in each interval.
    """
    keys = list(keys)
    hist = hist.withColumns({"_day": F.unix_date(F.to_date("w")), "w": F.unix_micros("w")})
    counts = hist.groupBy(*keys, "w").agg(F.sum("count").alias("total"))
    known = hist.groupBy(*keys, "_day", "w", "value").agg(F.sum("count").alias("count"))
    valued = known.where("value IS NOT NULL").withColumn("cell", cell(F.col("value")))
    # an interval with null values only asks for the day so far, and adds nothing to it
    there = F.col("value").isNotNull()
    cells = known.groupBy(*keys, "_day", "w", F.coalesce(cell(F.col("value")), F.lit(0).cast("long")).alias("cell")).agg(
        F.sum(F.when(there, F.col("count")).otherwise(0)).alias("n"), F.coalesce(F.min("value"), F.lit((1 << 63) - 1)).alias("low"),
        F.coalesce(F.max("value"), F.lit(-(1 << 63))).alias("high"),
        F.coalesce(F.sum(F.col("value").cast("decimal(19,0)") * F.col("count").cast("decimal(18,0)")), F.lit(0)).cast("decimal(38,0)").alias("s"))
    types = _types(valued, [*keys, "_day", "w"])
    # keys share groups, which saves a call for each of very many small keys; a group is at most so much larger than its largest key
    parts = GROUPS * int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def group(*columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(parts)).alias("_group")
    summary = cells.groupBy(group(*keys, "_day")).applyInPandas(
        _until_cells(keys, probs), f"{types}, n long, min long, max long, mean double, cells array<long>, ranks array<long>")
    if wanted is not None:
        times = wanted.select(F.unix_micros("w").alias("w")).distinct()
        counts, summary = (df.join(times, "w", "left_semi") for df in (counts, summary))
    asked = summary.select(*keys, "_day", "w", F.posexplode(F.arrays_zip("cells", "ranks")).alias("slot", "_z")).select(
        *keys, "_day", "w", "slot", F.col("_z.cells").alias("cell"), F.col("_z.ranks").alias("rank"))
    place = [*keys, "_day", "cell"]
    opened = asked.select(*place).distinct()
    on = [F.col(f"v.{k}").eqNullSafe(F.col(f"o.{k}")) for k in place]
    inside = valued.alias("v").join(opened.alias("o"), on, "left_semi").select("v.*")
    found = inside.groupBy(group(*place)).cogroup(asked.groupBy(group(*place))).applyInPandas(_until_values(keys), f"{types}, slot int, found long")
    per = found.groupBy(*keys, "w").agg(*[F.max(F.when(F.col("slot") == i, F.col("found"))).alias(f"_v{i}") for i in range(2 * len(probs))])
    joined = lookup(summary.drop("_day", "cells", "ranks"), per, [*keys, "w"])

    def percentile(i: int, p: float) -> Column:
        rank = F.lit(p) * (F.col("n") - 1)
        return F.col(f"_v{2 * i}") + (F.col(f"_v{2 * i + 1}") - F.col(f"_v{2 * i}")) * (rank - F.floor(rank))
    with_marks = joined.select(*keys, "w", "n", "min", "max", "mean", *[percentile(i, p).alias(probability_name(p)) for i, p in enumerate(probs)])
    return lookup(counts, with_marks, [*keys, "w"]).withColumn("w", F.timestamp_micros("w"))
