"""Stored-result queries and dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.functions import expressions as E
from tracewell.operators import metrics, outliers, search, snapshots, trees
from tracewell.plans.registry import query
from tracewell.plans.requests import rate_sql, rounded
from tracewell.plans.spans import KEPT, METRIC_ROWS, QPS_LIVES, interval_metrics, normalized, tree_spans
from tracewell.plans.sql_views import V_ACCESS, V_NORM, V_SPAN, with_views
from tracewell.session import stage
from tracewell.sources import derived

HALF_HOUR, HOUR = 1_800, 3_600
HIT = with_views(V_SPAN, V_NORM, KEPT)
SNAP = with_views(V_SPAN, V_NORM, METRIC_ROWS) + """
, snap AS (SELECT w AS create_time, app, name, CASE WHEN metric_kind IS NULL THEN -1 ELSE 1 END AS span_pid,
           CASE WHEN metric_kind IS NULL THEN name ELSE metric_kind || '||' || name END AS span_name, total AS span_total,
           qps AS span_qps, cost AS span_cost, errors AS span_errors, error_rate AS span_error_rate FROM v_metric)"""
REPORT = with_views(V_ACCESS, """
binned AS (SELECT app, uri, to_timestamp(epoch_us(ts) // 900000000 * 900)::TIMESTAMP AS w, ts FROM v_access)""",
                    rate_sql("binned", "app, uri, w", "w + INTERVAL 15 MINUTE")) + """
, meter AS (SELECT app || '-' || uri AS name, w + INTERVAL 15 MINUTE AS report_time, total AS count, m1_rate, m5_rate,
            m15_rate FROM rated)
, hist AS (SELECT app || '-COST-' || uri AS name, date_trunc('day', ts) + INTERVAL 1 DAY AS report_time,
           avg(cost_ms) AS mean, quantile_cont(cost_ms, 0.95) AS p95 FROM v_access GROUP BY ALL)"""


def _bucket(ts: str, seconds: int) -> str:
    return f"to_timestamp(epoch_us({ts}) // 1000000 // {seconds} * {seconds})::TIMESTAMP"


def _top(source: str, term: str, order: str, n: int) -> str:
    return f"(SELECT {term} FROM {source} GROUP BY {term} ORDER BY {order} LIMIT {n})"


def kept(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.kept_traces(normalized(spark, sf))


def snapshot_docs(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.with_largest_rate(interval_metrics(spark, sf), ["app", "metric_kind", "name"], "w", QPS_LIVES)
    return search.snapshots(rows, "w")


def snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    return search.nested_rows(snapshot_docs(spark, sf))


def meters(spark: SparkSession, sf: str) -> DataFrame:
    """Rate report rows of the request metrics, one per name and quarter hour."""
    binned = derived.access(spark, sf).withColumn("w", E.bucket_start(F.col("ts"), 900))
    end = F.col("w") + F.expr("INTERVAL 15 MINUTES")
    rated = metrics.rates(binned, ["app", "uri", "w"], "ts", end)
    return rated.select(E.request_metric_name(F.col("app"), F.col("uri")).alias("name"), end.alias("report_time"),
                        F.col("total").alias("count"), "m1_rate", "m5_rate", "m15_rate")


def histograms(spark: SparkSession, sf: str) -> DataFrame:
    """Latency report rows of the request metrics, one per name and day."""
    daily = derived.access(spark, sf).withColumn("day", F.date_trunc("DAY", "ts"))
    out = metrics.latency(daily, ["app", "uri", "day"], "cost_ms", probs=(0.95,), width=1000)
    return out.select(E.request_metric_name(F.col("app"), F.col("uri"), F.lit("COST-")).alias("name"),
                      E.next_midnight(F.col("day")).alias("report_time"), "mean", "p95")


@query("snapshot_15m", with_views(V_ACCESS) + """
, b AS (SELECT *, to_timestamp(epoch_us(ts) // 900000000 * 900)::TIMESTAMP AS w FROM v_access),
c AS (SELECT app, uri, w, count(*) AS total FROM b GROUP BY ALL)
SELECT c.app, c.uri, c.w, c.total, count(*) AS n, min(cost_ms) AS min, max(cost_ms) AS max,
       round(avg(cost_ms), 4) AS mean, round(quantile_cont(cost_ms, 0.95), 4) AS p95, round(quantile_cont(cost_ms, 0.99), 4) AS p99
FROM c JOIN b ON b.app = c.app AND b.uri = c.uri AND date_trunc('day', b.ts) = date_trunc('day', c.w)
     AND b.ts < c.w + INTERVAL 15 MINUTE GROUP BY ALL""")
def snapshot_15m(spark, sf):
    hist = snapshots.interval_histograms(derived.access(spark, sf), ["app", "uri"], "ts", "cost_ms")
    return rounded(snapshots.day_to_date(hist, ["app", "uri"], (0.95, 0.99)), "mean", "p95", "p99")


@query("nested_exists", SNAP + """
SELECT DISTINCT create_time, app, name FROM snap WHERE span_pid = -1 AND span_cost > 3000000""")
def nested_exists(spark, sf):
    return search.nested_exists(snapshot_docs(spark, sf), 3_000_000.0).select("create_time", "app", "name")


@query("nested_terms_avg", SNAP + """
SELECT span_name, round(avg(span_cost), 4) AS avg_cost, count(*) AS n FROM snap GROUP BY ALL""")
def nested_terms_avg(spark, sf):
    out = search.terms(snapshot_rows(spark, sf), "span_name",
                       {"avg_cost": F.avg("span_cost"), "n": F.count("*")})
    return rounded(out, "avg_cost")


@query("outer_terms_nested_avg", SNAP + """
SELECT name, round(avg(span_cost), 4) AS avg_cost FROM snap GROUP BY ALL ORDER BY name DESC LIMIT 10""")
def outer_terms_nested_avg(spark, sf):
    return rounded(search.terms(snapshot_rows(spark, sf), "name", {"avg_cost": F.avg("span_cost")}, 10), "avg_cost")


@query("terms_avg", HIT + """
SELECT span_name, round(avg(duration), 4) AS avg_duration, max(duration) AS max_duration, min(duration) AS min_duration
FROM v_trace_hit GROUP BY ALL ORDER BY avg(duration) DESC, span_name LIMIT 10""")
def terms_avg(spark, sf):
    out = search.terms(kept(spark, sf), "span_name", {
        "avg_duration": F.avg("duration"), "max_duration": F.max("duration"), "min_duration": F.min("duration")},
        10, "avg_duration")
    return rounded(out, "avg_duration")


@query("trace_search", HIT + """
SELECT app, type, trace_id, span_id, row_key, span_name, duration, create_time, (SELECT count(*) FROM v_trace_hit
  WHERE app = 'svc1' AND type = 'COST' AND span_name = '/p1' AND create_time BETWEEN TIMESTAMP '2024-02-29 23:00:00' AND TIMESTAMP '2024-03-01 00:59:59') AS total
FROM v_trace_hit WHERE app = 'svc1' AND type = 'COST' AND span_name = '/p1'
  AND create_time BETWEEN TIMESTAMP '2024-02-29 23:00:00' AND TIMESTAMP '2024-03-01 00:59:59'
ORDER BY create_time DESC, duration DESC, trace_id, span_id, row_key LIMIT 20""")
def trace_search(spark, sf):
    """First page of the matching kept traces, with the number of all matches."""
    found = stage(search.search_traces(kept(spark, sf), "svc1", "COST", "/p1", "2024-02-29 23:00:00", "2024-03-01 00:59:59"), "found")
    order = [F.desc("create_time"), F.desc("duration"), F.asc("trace_id"), F.asc("span_id"), F.asc("row_key")]
    first = search.page(found, order)
    total = found.agg(F.count("*").alias("total")).withColumn("_one", F.lit(1))
    return first.withColumn("_one", F.lit(1)).join(total, "_one").drop("_one")


@query("page_total", HIT + "SELECT count(*) AS total FROM v_trace_hit WHERE type = 'ERROR'")
def page_total(spark, sf):
    return search.search_traces(kept(spark, sf), type_="ERROR").agg(F.count("*").alias("total"))


@query("apps", with_views(V_SPAN, V_NORM) + """
SELECT DISTINCT node_app AS app FROM v_norm WHERE tag_sql IS NULL AND parent_id IS NULL""")
def apps(spark, sf):
    return trees.nodes(tree_spans(spark, sf)).where("parent_id is null").select("app").distinct()


@query("app_spans", with_views(V_SPAN, V_NORM) + """
SELECT DISTINCT node_name AS name FROM v_norm WHERE tag_sql IS NULL AND parent_id IS NULL AND node_app = 'svc1'""")
def app_spans(spark, sf):
    return trees.nodes(tree_spans(spark, sf)).where("parent_id is null and app = 'svc1'").select("name").distinct()


@query("panel_rate", REPORT + f"""
SELECT {_bucket('report_time', HOUR)} AS bucket, name, round(avg(m1_rate), 6) AS value FROM meter GROUP BY ALL""")
def panel_rate(spark, sf):
    return rounded(search.panel(meters(spark, sf), "report_time", "name", {"value": F.avg("m1_rate")}, HOUR),
                   "value", places=6)


@query("panel_cost_line", REPORT + f"""
, f AS (SELECT * FROM hist WHERE name LIKE 'app1-COST-%')
SELECT {_bucket('report_time', 86400)} AS bucket, name, round(max(mean), 4) AS value FROM f
WHERE name IN {_top('f', 'name', 'name DESC', 10)} GROUP BY ALL""")
def panel_cost_line(spark, sf):
    rows = histograms(spark, sf).where("name like 'app1-COST-%'")
    return rounded(search.panel(rows, "report_time", "name", {"value": F.max("mean")}, 86_400, 10), "value")


@query("panel_cost_p95", REPORT + f"""
, f AS (SELECT * FROM hist WHERE name LIKE 'app1-COST-%')
SELECT {_bucket('report_time', 86400)} AS bucket, name, round(max(p95), 4) AS value FROM f
WHERE name IN {_top('f', 'name', 'name DESC', 10)} GROUP BY ALL""")
def panel_cost_p95(spark, sf):
    rows = histograms(spark, sf).where("name like 'app1-COST-%'")
    return rounded(search.panel(rows, "report_time", "name", {"value": F.max("p95")}, 86_400, 10), "value")


@query("panel_count_trend", REPORT + f"""
SELECT {_bucket('report_time', HOUR)} AS bucket, name, max(count) AS value FROM meter
WHERE name IN {_top('meter', 'name', 'name DESC', 20)} GROUP BY ALL""")
def panel_count_trend(spark, sf):
    return search.panel(meters(spark, sf), "report_time", "name", {"value": F.max("count")}, HOUR, 20)


def _endpoint(spark, sf):
    return snapshot_rows(spark, sf).where("app = 'svc1' and name = '/p1'")


ONE = "app = 'svc1' AND name = '/p1'"


@query("panel_qps", SNAP + f"""
SELECT {_bucket('create_time', HALF_HOUR)} AS bucket, name, round(avg(span_qps), 6) AS value FROM snap WHERE {ONE} GROUP BY ALL""")
def panel_qps(spark, sf):
    out = search.panel(_endpoint(spark, sf), "create_time", "name", {"value": F.avg("span_qps")}, HALF_HOUR, 20,
                       F.avg("span_qps"))
    return rounded(out, "value", places=6)


@query("panel_total_errors", SNAP + f"""
SELECT {_bucket('create_time', HALF_HOUR)} AS bucket, name, max(span_total) AS total, CAST(max(span_errors) AS BIGINT) AS errors
FROM snap WHERE {ONE} GROUP BY ALL""")
def panel_total_errors(spark, sf):
    return search.panel(_endpoint(spark, sf), "create_time", "name", {
        "total": F.max("span_total"), "errors": F.max("span_errors")}, HALF_HOUR, 10, F.max("span_total"))


@query("panel_cost", SNAP + f"""
SELECT {_bucket('create_time', HALF_HOUR)} AS bucket, name, round(avg(span_cost), 4) AS value FROM snap WHERE {ONE} GROUP BY ALL""")
def panel_cost(spark, sf):
    return rounded(search.panel(_endpoint(spark, sf), "create_time", "name", {"value": F.avg("span_cost")}, HALF_HOUR, 20,
                                F.avg("span_cost")), "value")


@query("panel_app_total", SNAP + f"""
, f AS (SELECT * FROM snap WHERE app = 'svc1')
SELECT {_bucket('create_time', HALF_HOUR)} AS bucket, name, max(span_total) AS value FROM f
WHERE name IN {_top('f', 'name', 'max(span_total) DESC, name', 10)} GROUP BY ALL""")
def panel_app_total(spark, sf):
    rows = snapshot_rows(spark, sf).where("app = 'svc1'")
    return search.panel(rows, "create_time", "name", {"value": F.max("span_total")}, HALF_HOUR, 10, F.max("span_total"))


@query("panel_error_rate", SNAP + f"""
, o AS (SELECT app FROM snap GROUP BY app ORDER BY app DESC LIMIT 10),
p AS (SELECT app, span_name FROM (SELECT DISTINCT app, span_name FROM snap WHERE app IN (SELECT app FROM o))
      QUALIFY row_number() OVER (PARTITION BY app ORDER BY span_name DESC) <= 10)
SELECT {_bucket('create_time', HALF_HOUR)} AS bucket, app AS "span_appName", span_name, round(avg(span_error_rate), 4) AS value
FROM snap JOIN p USING (app, span_name) GROUP BY ALL""")
def panel_error_rate(spark, sf):
    return rounded(search.panel_two_terms(snapshot_rows(spark, sf), "create_time", "span_appName", "span_name",
                                          {"value": F.avg("span_errorRate")}, HALF_HOUR, 10), "value")


@query("panel_p95_table", REPORT + """
SELECT name, round(max(p95), 4) AS max_p95, round(min(p95), 4) AS min_p95 FROM hist GROUP BY name ORDER BY name DESC LIMIT 10""")
def panel_p95_table(spark, sf):
    out = search.terms(histograms(spark, sf), "name", {"max_p95": F.max("p95"), "min_p95": F.min("p95")}, 10)
    return rounded(out, "max_p95", "min_p95")


@query("panel_p95_line", REPORT + f"""
SELECT {_bucket('report_time', 86400)} AS bucket, name, round(max(p95), 4) AS value FROM hist
WHERE name IN {_top('hist', 'name', 'name DESC', 20)} GROUP BY ALL""")
def panel_p95_line(spark, sf):
    return rounded(search.panel(histograms(spark, sf), "report_time", "name", {"value": F.max("p95")}, 86_400, 20),
                   "value")
