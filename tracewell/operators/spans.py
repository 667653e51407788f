"""Span-level operators: keys, filters, ordering and regrouping by trace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tracewell.functions import expressions as E
from tracewell.functions.scale import running_count

ORDER = ["ts", "span_id", "kind", "row_key"]


def order_key(*columns: str) -> Column:
    """A comparable struct giving spans of one trace their fixed order."""
    return F.struct(*(columns or ORDER))


def normalize(spans: DataFrame) -> DataFrame:
    """Apply the path override and add tree-node and metric keys."""
    named = spans.withColumn("name", E.endpoint_name(F.col("name")))
    kind = E.metric_kind(F.col("parent_id"), F.col("kind"))
    return named.withColumns({
        "node_app": F.coalesce("remote_service", "local_service"),
        "node_name": F.when(F.col("parent_id").isNull(), F.col("name")).otherwise(
            F.concat(kind, F.lit(E.SEPARATOR), "name")),
        "app": F.col("local_service"),
        "metric_kind": kind,
    })


def without_database(spans: DataFrame) -> DataFrame:
    """Drop database spans; spans without tags stay."""
    return spans.where(F.col("tags").isNull() | ~E.has_tag(E.TAG_SQL))


def without_database_strict(spans: DataFrame) -> DataFrame:
    """Drop database spans and spans without tags."""
    return spans.where(F.col("tags").isNotNull() & ~E.has_tag(E.TAG_SQL))


def not_late(spans: DataFrame, now: Column, minutes: int = 15) -> DataFrame:
    """Drop spans whose age in whole minutes exceeds ``minutes``."""
    age = F.floor((F.unix_millis(now) - F.floor(F.unix_micros("ts") / 1000)) / 60_000)
    return spans.where(age - minutes <= 0)


def distinct_spans(spans: DataFrame) -> DataFrame:
    """One row per distinct span; ``row_key`` identifies the content."""
    return spans.dropDuplicates(["trace_id", "span_id", "row_key"])


def trace_sorted(spans: DataFrame) -> DataFrame:
    """Spans with their position in the time order of their trace."""
    return running_count(spans, ["trace_id"], ORDER)


def bridge(spans: DataFrame, batch: Column | None = None) -> DataFrame:
    """Regroup distinct spans into ``(trace_id, part, value)`` messages, value being a JSON array.

    There is one message per trace and incoming batch; ``batch`` numbers the batches of the rows, and the number is the
    message's ``part``. Without it all rows are one batch.
    """
    numbered = spans.withColumn("part", F.lit(0) if batch is None else batch.cast("int"))
    parts = numbered.dropDuplicates(["trace_id", "span_id", "row_key"])
    wire = F.struct(
        F.col("trace_id").alias("traceId"), F.col("span_id").alias("id"), F.col("parent_id").alias("parentId"),
        "kind", "name", F.unix_micros("ts").alias("timestamp"), "duration",
        F.struct(F.col("local_service").alias("serviceName")).alias("localEndpoint"),
        F.when(F.col("remote_service").isNotNull(), F.struct(F.col("remote_service").alias("serviceName")))
        .alias("remoteEndpoint"), "tags")
    ordered = F.sort_array(F.collect_list(F.struct(*ORDER, F.to_json(wire).alias("json"))))
    return parts.groupBy("trace_id", "part").agg(
        F.concat(F.lit("["), F.array_join(ordered["json"], ","), F.lit("]")).alias("value"),
        F.count("*").alias("spans"))


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return newest.select(*keys, "_r.*")
