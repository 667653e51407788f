"""Span queries: decoding, keys, filters, outliers and endpoint metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.functions import expressions as E
from tracewell.functions.scale import in_parts
from tracewell.operators import metrics, outliers, parse, spans as S
from tracewell.plans.registry import query
from tracewell.plans.requests import rate_sql, rounded
from tracewell.plans.sql_views import V_NORM, V_SPAN, with_views
from tracewell.session import stage
from tracewell.sources import derived

SPAN = with_views(V_SPAN)
NORM = with_views(V_SPAN, V_NORM)
FAILED = "tag_error IS NOT NULL AND tag_error <> '200'"
NOW = "2024-03-01 00:40:00"
MIDNIGHT = "2024-03-01"

MESSAGE_KEYS = "trace_id, span_id, kind, name, duration, local_service, remote_service"


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return S.normalize(derived.spans(spark, sf))


def tree_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Spans as the tree and metric layers use them: no database spans, keys added."""
    return S.normalize(S.without_database(derived.spans(spark, sf)))


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Span topic messages, written out and read back the way a topic dump would be."""
    return stage(derived.span_messages(derived.spans(spark, sf)), "messages")


def decoded_columns(df: DataFrame) -> DataFrame:
    return df.select("trace_id", "span_id", "parent_id", "kind", "name", "ts", "duration", "local_service",
                     "remote_service", F.col("tags")["error"].alias("tag_error"))


DECODED_SQL = """SELECT trace_id, span_id, parent_id, kind, name, ts, duration, local_service, remote_service,
tag_error FROM v_span WHERE """


@query("span_decode", SPAN + """
SELECT CASE WHEN l_partkey % 50 = 2 THEN ' ' ELSE trace_id END AS trace_id, span_id, parent_id, kind, name, ts,
duration, local_service, remote_service, tag_error FROM v_span WHERE l_partkey % 50 NOT IN (0, 1, 4, 5, 6)""")
def span_decode(spark, sf):
    return decoded_columns(parse.span_arrays(messages(spark, sf)))


@query("span_decode_tolerant", SPAN + DECODED_SQL + "l_partkey % 50 NOT IN (0, 2, 4, 5, 6)")
def span_decode_tolerant(spark, sf):
    return decoded_columns(parse.span_arrays_tolerant(messages(spark, sf)))


@query("quarantine", SPAN + """
SELECT trace_id, span_id, CASE WHEN l_partkey % 50 = 0 THEN 'not a JSON array' ELSE 'bad element' END AS reason
FROM v_span WHERE l_partkey % 50 IN (0, 1, 4, 5, 6)""")
def quarantine(spark, sf):
    return parse.quarantine(messages(spark, sf)).select("trace_id", "span_id", "reason")


@query("span_normalize", NORM + """
SELECT trace_id, span_id, coalesce(parent_id, '-1') AS parent_id, name, node_app, node_name, app, metric_kind,
app || CASE WHEN metric_kind IS NULL THEN '' ELSE '||' || metric_kind END || '||' || name AS metric_name FROM v_norm""")
def span_normalize(spark, sf):
    return normalized(spark, sf).select(
        "trace_id", "span_id", F.coalesce("parent_id", F.lit(E.ROOT_PARENT)).alias("parent_id"), "name", "node_app",
        "node_name", "app", "metric_kind",
        E.span_metric_name(F.col("app"), F.col("metric_kind"), F.col("name")).alias("metric_name"))


@query("span_filter", SPAN + "SELECT trace_id, span_id, row_key FROM v_span WHERE tag_sql IS NULL")
def span_filter(spark, sf):
    return S.without_database(derived.spans(spark, sf)).select("trace_id", "span_id", "row_key")


def _some_untagged(df: DataFrame) -> DataFrame:
    part = F.split("row_key", "-").getItem(0).cast("long")
    return df.withColumn("tags", F.when(part % 5 != 0, F.col("tags")))


@query("span_filter_strict", SPAN + """
SELECT trace_id, span_id, row_key FROM v_span WHERE tag_sql IS NULL AND l_partkey % 5 <> 0""")
def span_filter_strict(spark, sf):
    """Spans of every fifth part carry no tags at all here."""
    return S.without_database_strict(_some_untagged(derived.spans(spark, sf))).select("trace_id", "span_id", "row_key")


@query("late_filter", SPAN + f"""
SELECT trace_id, span_id, row_key FROM v_span
WHERE (epoch_us(TIMESTAMP '{NOW}') // 1000 - epoch_us(ts) // 1000) // 60000 - 15 <= 0""")
def late_filter(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    return S.not_late(derived.spans(spark, sf), now).select("trace_id", "span_id", "row_key")


@query("topo_node_name", SPAN + """
SELECT DISTINCT local_service || '|' || coalesce(tag_type, 'null') || ':' ||
       CASE WHEN tag_sql IS NULL THEN name ELSE 'DB-READ' END AS local_node,
       remote_service || '|' || coalesce(tag_type, 'null') || ':' ||
       CASE WHEN tag_sql IS NULL THEN name ELSE 'DB-READ' END AS remote_node FROM v_span""")
def topo_node_name(spark, sf):
    return derived.spans(spark, sf).select(
        E.topology_node(F.col("local_service"), F.col("name")).alias("local_node"),
        E.topology_node(F.col("remote_service"), F.col("name")).alias("remote_node")).distinct()


@query("trace_sorted", SPAN + """
SELECT trace_id, span_id, row_key,
       row_number() OVER (PARTITION BY trace_id ORDER BY ts, span_id, kind NULLS FIRST, row_key) AS pos FROM v_span""")
def trace_sorted(spark, sf):
    return S.trace_sorted(derived.spans(spark, sf)).select("trace_id", "span_id", "row_key", "pos")


@query("span_bridge", SPAN + """
SELECT trace_id, 0 AS part, count(DISTINCT (span_id, row_key)) AS spans,
       string_agg(span_id || '@' || duration, ',' ORDER BY ts, span_id, kind NULLS FIRST, row_key) AS members FROM v_span GROUP BY trace_id""")
def span_bridge(spark, sf):
    messages = S.bridge(derived.spans(spark, sf))
    inside = F.from_json("value", "array<struct<id:string,duration:bigint>>")
    members = F.transform(inside, lambda s: F.concat(s["id"], F.lit("@"), s["duration"].cast("string")))
    return messages.select("trace_id", "part", "spans", F.array_join(members, ",").alias("members"))


@query("last_per_key", SPAN + """
SELECT trace_id, span_id, row_key, ts, duration FROM (SELECT *, row_number() OVER (
  PARTITION BY trace_id ORDER BY ts DESC, span_id DESC, row_key DESC) AS rn FROM v_span) WHERE rn = 1""")
def last_per_key(spark, sf):
    rows = derived.spans(spark, sf).select("trace_id", "span_id", "row_key", "ts", "duration")
    return S.last_per_key(rows, ["trace_id"], ["ts", "span_id", "row_key"])


SLOW = """stats AS (
  SELECT *, count(*) OVER w AS seen, sum(duration) OVER w AS total, avg(duration) OVER w AS mean, stddev_pop(duration) OVER w AS sd FROM v_norm
  WINDOW w AS (PARTITION BY app, metric_kind, name ORDER BY ts, trace_id, span_id, row_key
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
slow AS (SELECT * FROM stats WHERE duration > mean AND sd > 0 AND (duration - sd) / sd > 0.7)"""

KEPT = SLOW + f""",
hits AS (SELECT 'ERROR' AS type, * FROM (SELECT * FROM v_norm WHERE {FAILED})
         UNION ALL SELECT 'COST' AS type, * EXCLUDE (seen, total, mean, sd) FROM slow),
v_trace_hit AS (SELECT app || CASE WHEN metric_kind IS NULL THEN '' ELSE '||' || metric_kind END AS app, type, trace_id,
         span_id, row_key, name AS span_name, duration, ts AS create_time FROM hits)"""


@query("slow_spans", with_views(V_SPAN, V_NORM, SLOW) + """
SELECT trace_id, span_id, row_key, seen AS run_n, CAST(total AS BIGINT) AS run_total, round(sd, 2) AS run_sd FROM slow""")
def slow_spans(spark, sf):
    return rounded(outliers.slow_spans(normalized(spark, sf)).select(
        "trace_id", "span_id", "row_key", "run_n", F.col("run_total").cast("long").alias("run_total"), "run_sd"),
        "run_sd", places=2)


@query("slow_spans_daily", with_views(V_SPAN, V_NORM, SLOW.replace("name ORDER", "name, date_trunc('day', ts) ORDER"))
       + "SELECT trace_id, span_id, row_key FROM slow")
def slow_spans_daily(spark, sf):
    return outliers.slow_spans(normalized(spark, sf), daily=True).select("trace_id", "span_id", "row_key")


@query("kept_traces", with_views(V_SPAN, V_NORM, KEPT) + "SELECT * FROM v_trace_hit")
def kept_traces(spark, sf):
    return outliers.kept_traces(normalized(spark, sf))


@query("sink_insert_absent", with_views(V_SPAN, V_NORM, KEPT) + f"""
SELECT app, type, trace_id, span_id, arg_min(duration, (create_time, row_key)) AS duration FROM v_trace_hit h
WHERE NOT EXISTS (SELECT 1 FROM v_trace_hit e WHERE e.create_time < TIMESTAMP '{MIDNIGHT}' AND e.trace_id = h.trace_id
  AND e.type = h.type AND e.app = h.app AND e.span_id = h.span_id)
GROUP BY ALL""")
def sink_insert_absent(spark, sf):
    found = in_parts(normalized(spark, sf), outliers.ENDPOINT, outliers.kept_traces)

    def inserted(hits: DataFrame) -> DataFrame:
        stored = hits.where(f"create_time < TIMESTAMP '{MIDNIGHT}'")
        return outliers.insert_absent(hits, stored).select("app", "type", "trace_id", "span_id", "duration")
    return in_parts(stage(found, "hits"), ["trace_id"], inserted)


INTERVAL_KEYS = ["w", "app", "metric_kind", "name"]
QPS_LIVES = 1_800  # seconds that a largest rate lives
METRIC_ROWS = f"""binned AS (SELECT *, to_timestamp(epoch_us(ts) // 900000000 * 900)::TIMESTAMP AS w FROM v_norm WHERE tag_sql IS NULL),
base AS (SELECT w, app, metric_kind, name, count(*) AS total, avg(duration) AS cost,
         quantile_cont(duration, 0.95) AS cost_tp95, quantile_cont(duration, 0.99) AS cost_tp99,
         max(duration) AS cost_max, count(*) FILTER ({FAILED}) AS errors FROM binned GROUP BY ALL),
""" + rate_sql("binned", "w, app, metric_kind, name", "w + INTERVAL 15 MINUTE", (15,)) + """,
v_metric AS (SELECT b.*, errors * 100.0 / b.total AS error_rate, m15_rate AS qps FROM base b JOIN rated r
  ON b.w = r.w AND b.app = r.app AND b.name = r.name AND b.metric_kind IS NOT DISTINCT FROM r.metric_kind)"""
# the largest rate is renewed by a larger one, or when it has lived its time
QPS_MAX = f""",
qps_n AS (SELECT *, epoch_us(w) // 1000000 AS t, row_number() OVER (PARTITION BY app, metric_kind, name ORDER BY w) AS rn FROM v_metric),
qps_fold AS (
  SELECT app, metric_kind, name, w, rn, qps AS qps_max, t AS since FROM qps_n WHERE rn = 1
  UNION ALL
  SELECT n.app, n.metric_kind, n.name, n.w, n.rn, CASE WHEN s THEN n.qps ELSE f.qps_max END, CASE WHEN s THEN n.t ELSE f.since END
  FROM qps_fold f JOIN (SELECT *, true AS one FROM qps_n) n ON n.app = f.app AND n.metric_kind IS NOT DISTINCT FROM f.metric_kind AND n.name = f.name
       AND n.rn = f.rn + 1, LATERAL (SELECT n.t >= f.since + {QPS_LIVES} OR n.qps > f.qps_max AS s))"""


def interval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Endpoint metric rows of each quarter hour."""
    rows = tree_spans(spark, sf).select(E.bucket_start(F.col("ts"), 900).alias("w"), "app", "metric_kind", "name", "ts", "duration", "tags")
    return in_parts(stage(rows, "timed"), INTERVAL_KEYS, lambda part: metrics.endpoint_metrics(part, INTERVAL_KEYS, F.col("w") + F.expr("INTERVAL 15 MINUTES")))


@query("metric_rows", with_views(V_SPAN, V_NORM, METRIC_ROWS) + QPS_MAX + """
SELECT m.w, m.app, m.metric_kind, m.name, total, round(cost, 4) AS cost, round(cost_tp95, 4) AS cost_tp95, round(cost_tp99, 4) AS cost_tp99, cost_max, errors,
       round(error_rate, 4) AS error_rate, round(qps, 6) AS qps, round(qps_max, 6) AS qps_max
FROM v_metric m JOIN qps_fold f ON m.w = f.w AND m.app = f.app AND m.name = f.name AND m.metric_kind IS NOT DISTINCT FROM f.metric_kind""")
def metric_rows(spark, sf):
    """Metric rows with the largest rate that still lives."""
    out = metrics.with_largest_rate(interval_metrics(spark, sf), ["app", "metric_kind", "name"], "w", QPS_LIVES)
    return rounded(rounded(out, "cost", "cost_tp95", "cost_tp99", "error_rate"), "qps", "qps_max", places=6)


@query("endpoint_totals", with_views(V_SPAN, V_NORM) + f"""
SELECT app, metric_kind, name, count(*) AS total, round(avg(duration), 4) AS cost,
       round(quantile_cont(duration, 0.95), 4) AS cost_tp95, round(quantile_cont(duration, 0.99), 4) AS cost_tp99,
       max(duration) AS cost_max, count(*) FILTER ({FAILED}) AS errors,
       round(count(*) FILTER ({FAILED}) * 100.0 / count(*), 4) AS error_rate
FROM v_norm WHERE tag_sql IS NULL GROUP BY ALL""")
def endpoint_totals(spark, sf):
    out = metrics.endpoint_metrics(tree_spans(spark, sf), ["app", "metric_kind", "name"])
    return rounded(out, "cost", "cost_tp95", "cost_tp99", "error_rate")
