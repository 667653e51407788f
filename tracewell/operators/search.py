"""Stored-result search: snapshots, nested conditions, terms aggregations, pages and dashboard panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewell.functions import expressions as E


def snapshots(metrics: DataFrame, at: str) -> DataFrame:
    """Metric rows as snapshot documents: one per time, app and url, with a nested row per call kind."""
    is_root = F.col("metric_kind").isNull()
    row = F.struct(
        F.when(is_root, F.lit(-1)).otherwise(1).cast("long").alias("pid"), F.col("app").alias("appName"),
        F.when(is_root, F.col("name")).otherwise(F.concat("metric_kind", F.lit(E.SEPARATOR), "name")).alias("name"),
        "total", "qps", F.col("qps_max").alias("qpsMax"), "cost", F.col("cost_tp99").alias("costTp99"),
        F.col("cost_tp95").alias("costTp95"), F.col("cost_max").alias("costMax"), "errors",
        F.col("error_rate").alias("errorRate"))
    return metrics.groupBy(F.col(at).alias("create_time"), "app", "name").agg(
        F.sort_array(F.collect_list(row)).alias("spans"))


def nested_rows(docs: DataFrame, column: str = "spans") -> DataFrame:
    """Documents with one output row per nested row, its fields prefixed ``span_``."""
    nested = docs.withColumn("_s", F.explode(column)).drop(column)
    fields = docs.schema[column].dataType.elementType.names
    return nested.select(*[c for c in nested.columns if c != "_s"],
                         *[F.col(f"_s.{f}").alias(f"span_{f}") for f in fields])


def nested_exists(docs: DataFrame, min_cost: float | None = None, column: str = "spans") -> DataFrame:
    """Documents with a root row, optionally one costing more than ``min_cost``."""
    def matches(s: Column) -> Column:
        root = s["pid"] == -1
        return root if min_cost is None else root & (s["cost"] > min_cost)
    return docs.where(F.exists(column, matches))


def terms(df: DataFrame, term: str, aggs: dict[str, Column], top: int = 0, by: str | None = None) -> DataFrame:
    """Terms aggregation: the ``top`` values by an aggregate, or by the term itself, descending; 0 is all."""
    out = df.groupBy(term).agg(*[c.alias(n) for n, c in aggs.items()])
    order = [F.desc(term)] if by is None else [F.desc_nulls_last(by), F.asc(term)]
    return out.orderBy(*order).limit(top) if top else out


def panel(df: DataFrame, ts: str, term: str, aggs: dict[str, Column], seconds: int, top: int = 0,
          by: Column | None = None) -> DataFrame:
    """Time buckets of the top terms: pick the terms over the whole range, then aggregate term by time.

    Terms are chosen by ``by`` (an aggregate) or by their own name, descending.
    """
    if top:
        chosen = terms(df, term, {"_by": F.max(term) if by is None else by}, top, None if by is None else "_by")
        df = df.join(chosen.select(term), term, "left_semi")
    return df.groupBy(E.bucket_start(F.col(ts), seconds).alias("bucket"), term).agg(
        *[c.alias(n) for n, c in aggs.items()])


def panel_two_terms(df: DataFrame, ts: str, outer: str, inner: str, aggs: dict[str, Column], seconds: int,
                    top: int) -> DataFrame:
    """Like ``panel`` with a second term level: the last ``top`` inner names of the last ``top`` outer names."""
    pairs = df.groupBy(outer, inner).agg(F.count("*").alias("_n"))
    outers = pairs.select(outer).distinct().orderBy(F.desc(outer)).limit(top)
    rank = Window.partitionBy(outer).orderBy(F.desc(inner))
    chosen = (pairs.join(outers, outer, "left_semi").withColumn("_r", F.row_number().over(rank))
              .where(F.col("_r") <= top).select(outer, inner))
    return df.join(chosen, [outer, inner], "left_semi").groupBy(
        E.bucket_start(F.col(ts), seconds).alias("bucket"), outer, inner).agg(
        *[c.alias(n) for n, c in aggs.items()])


def search_traces(hits: DataFrame, app: str | None = None, type_: str | None = None, name: str | None = None,
                  start: str | None = None, end: str | None = None) -> DataFrame:
    """Kept traces by app, type, span name and creation time (both ends included)."""
    wanted = {"app": app, "type": type_, "span_name": name}
    for column, value in wanted.items():
        if value is not None:
            hits = hits.where(F.col(column) == value)
    if start is not None:
        hits = hits.where(F.col("create_time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        hits = hits.where(F.col("create_time") <= F.lit(end).cast("timestamp"))
    return hits


def page(df: DataFrame, order: Sequence[Column], number: int = 0, size: int = 20) -> DataFrame:
    """One page of the ordered rows; ``order`` should end in a unique column."""
    return df.orderBy(*order).offset(number * size).limit(size)


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: int = 20) -> DataFrame:
    """The first ``size`` rows of each key; the limit is applied before the shuffle as well."""
    rank = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= size)


def distinct_by(df: DataFrame, key: str, order: str) -> DataFrame:
    """One document per distinct key, the one with the smallest ``order``."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def sliding_max(df: DataFrame, keys: Sequence[str], t: str, v: str, seconds: int) -> DataFrame:
    """Largest value of the last ``seconds`` per key, over per-interval rows."""
    recent = Window.partitionBy(*keys).orderBy(t).rangeBetween(-seconds, 0)
    return df.withColumn(f"{v}_max", F.max(v).over(recent))
