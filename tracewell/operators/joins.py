"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tracewell.functions.expressions import UNKNOWN_AREA


def area_lookup(rows: DataFrame, areas: DataFrame, key: str, default: str = UNKNOWN_AREA) -> DataFrame:
    """Add the ``area`` of each row's key, or a default label.

    The lookup table is reduced to one row per key first. No broadcast is forced: Spark broadcasts it
    while it is under its size threshold and otherwise shuffles, splitting hot keys at run time.
    """
    unique = areas.groupBy(key).agg(F.min("area").alias("area"))
    return rows.join(unique, key, "left").withColumn("area", F.coalesce("area", F.lit(default)))
