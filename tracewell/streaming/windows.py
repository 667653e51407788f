"""Windowed and running counts; the same function serves a batch and a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def windowed_counts(df: DataFrame, ts: str, key: Column, width: str, slide: str | None = None,
                    late: str | None = None, panes: bool = True) -> DataFrame:
    """Rows per key and time window. ``late`` is the lateness a stream tolerates.

    Sliding windows, whose width must be a multiple of the slide, are added up from panes: rows are counted once per pane of a slide's width, and only these counts are copied into
    the windows that hold the pane. A stream then has two aggregations, which Spark allows in append mode; for update mode ``panes`` must be off.
    """
    source = df if late is None else df.withWatermark(ts, late)
    if slide is None or not panes:
        window = F.window(ts, width, slide) if slide else F.window(ts, width)
        counted = source.groupBy(window, key.alias("key")).agg(F.count("*").alias("n"))
    else:
        pane = source.groupBy(F.window(ts, slide).alias("pane"), key.alias("key")).agg(F.count("*").alias("m"))
        counted = pane.groupBy(F.window(F.window_time("pane"), width, slide), "key").agg(F.sum("m").alias("n"))
    return counted.select(F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), "key", "n")


def running_counts(df: DataFrame, key: Column) -> DataFrame:
    """Rows per key so far; in complete mode every trigger emits all keys again."""
    return df.groupBy(key.alias("key")).agg(F.count("*").alias("n"))
