"""Request-log queries: decoding, counts, errors, latency, rates and windows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.functions import expressions as E
from tracewell.operators import joins, metrics, parse
from tracewell.plans.registry import query
from tracewell.plans.sql_views import V_ACCESS, with_views
from tracewell.sources import derived

ACCESS = with_views(V_ACCESS)
PERCENTILE_SQL = ", ".join(
    f"round(quantile_cont({{v}}, {p}), 4) AS {n}" for p, n in
    ((0.5, "p50"), (0.75, "p75"), (0.95, "p95"), (0.98, "p98"), (0.99, "p99"), (0.999, "p999")))


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Requests decoded from their JSON envelopes."""
    return parse.request_logs(derived.envelopes(derived.access(spark, sf)))


def rounded(df: DataFrame, *names: str, places: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query("log_parse", ACCESS + """
SELECT event_id, upper(app) AS app, date_trunc('milliseconds', ts) AS ts, uri, 'GET' AS method, http_code,
       cost_ms, epoch_us(ts) // 1000 AS start_ms, epoch_us(ts) // 1000 + cost_ms AS end_ms FROM v_access""")
def log_parse(spark, sf):
    return parsed(spark, sf).select(
        "event_id", "app", "ts", "uri", "method", "http_code", "cost_ms", "start_ms", "end_ms")


@query("log_biz_code", ACCESS + "SELECT event_id, biz_code FROM v_access")
def log_biz_code(spark, sf):
    return parsed(spark, sf).select("event_id", parse.business_code().alias("biz_code"))


@query("uri_count", ACCESS + "SELECT upper(app) AS app, uri, count(*) AS total FROM v_access GROUP BY ALL")
def uri_count(spark, sf):
    return metrics.counts(parsed(spark, sf), ["app", "uri"])


@query("http_errors", ACCESS + """
SELECT app, uri, http_code, count(*) AS errors FROM v_access WHERE http_code <> 200 GROUP BY ALL""")
def http_errors(spark, sf):
    return metrics.counts(derived.access(spark, sf), ["app", "uri", "http_code"], "errors",
                          F.col("http_code") != 200)


@query("biz_code_count", ACCESS + """
SELECT upper(app) AS app, uri, biz_code, count(*) AS total FROM v_access WHERE biz_code IS NOT NULL GROUP BY ALL""")
def biz_code_count(spark, sf):
    coded = parsed(spark, sf).withColumn("biz_code", parse.business_code())
    return metrics.counts(coded, ["app", "uri", "biz_code"], where=F.col("biz_code").isNotNull())


@query("cost_hist", ACCESS + f"""
SELECT app, uri, count(*) AS n, min(cost_ms) AS min, max(cost_ms) AS max, round(avg(cost_ms), 4) AS mean,
       round(stddev_pop(cost_ms), 4) AS stddev, {PERCENTILE_SQL.format(v='cost_ms')}
FROM v_access WHERE cost_ms > 0 GROUP BY app, uri""")
def cost_hist(spark, sf):
    out = metrics.latency(derived.access(spark, sf), ["app", "uri"], "cost_ms", positive_only=True, width=1000)
    return rounded(out.drop("rows"), "mean", "stddev", "p50", "p75", "p95", "p98", "p99", "p999")


@query("request_summary", ACCESS + """
SELECT upper(app) AS app, uri, count(*) AS total, count(*) FILTER (http_code <> 200) AS errors,
       round(count(*) FILTER (http_code <> 200) * 100.0 / count(*), 4) AS error_rate,
       round(avg(cost_ms), 4) AS cost, round(quantile_cont(cost_ms, 0.95), 4) AS cost_tp95,
       round(quantile_cont(cost_ms, 0.99), 4) AS cost_tp99, max(cost_ms) AS cost_max
FROM v_access GROUP BY 1, 2""")
def request_summary(spark, sf):
    """The flagship: envelopes decoded and summed up per endpoint in one histogram pass."""
    failed = (F.col("http_code") != 200).cast("long")
    out = metrics.distribution(parsed(spark, sf), ["app", "uri"], "cost_ms", (0.95, 0.99), width=1000,
                               sums={"errors": failed})
    return rounded(out.select(
        "app", "uri", F.col("rows").alias("total"), "errors",
        E.error_rate(F.col("errors"), F.col("rows")).alias("error_rate"), F.col("mean").alias("cost"),
        F.col("p95").alias("cost_tp95"), F.col("p99").alias("cost_tp99"), F.col("max").alias("cost_max")),
        "error_rate", "cost", "cost_tp95", "cost_tp99")


@query("cost_hist_overall", ACCESS + f"""
SELECT count(*) AS n, min(cost_ms) AS min, max(cost_ms) AS max, round(avg(cost_ms), 4) AS mean,
       round(stddev_pop(cost_ms), 4) AS stddev, {PERCENTILE_SQL.format(v='cost_ms')}
FROM v_access""")
def cost_hist_overall(spark, sf):
    out = metrics.latency(derived.access(spark, sf), [], "cost_ms", width=1000)
    return rounded(out.drop("rows"), "mean", "stddev", "p50", "p75", "p95", "p98", "p99", "p999")


def rate_sql(source: str, keys: str, end: str, minutes=(1, 5, 15), ts: str = "ts", weight: str = "1") -> str:
    """CTEs ``ticks`` and ``rated`` computing the moving rates over ``source`` grouped by ``keys``."""
    terms = []
    for m in minutes:
        a = repr(1 - math.exp(-5 / (60.0 * m)))
        terms.append(f"""coalesce(sum(CASE WHEN k < nt THEN n / 5.0 *
            CASE WHEN k = 0 THEN pow(1 - {a}, nt - 1) ELSE {a} * pow(1 - {a}, nt - 1 - k) END END), 0) AS m{m}_rate""")
    using = " AND ".join(f"s.{k.strip()} IS NOT DISTINCT FROM f.{k.strip()}" for k in keys.split(","))
    picked = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
    return f"""firsts AS (SELECT {keys}, min({ts}) AS t0 FROM {source} GROUP BY ALL),
ticks AS (SELECT {picked}, f.t0, (epoch_us(s.{ts}) - epoch_us(f.t0)) // 5000000 AS k, sum({weight}) AS n
          FROM {source} s JOIN firsts f ON {using} GROUP BY ALL),
timed AS (SELECT *, epoch_us({end}) - epoch_us(t0) AS el, (epoch_us({end}) - epoch_us(t0)) // 5000000 AS nt FROM ticks),
rated AS (SELECT {keys}, CAST(sum(n) AS BIGINT) AS total,
          CASE WHEN max(el) > 0 THEN sum(n) * 1e6 / max(el) ELSE 0 END AS mean_rate, {', '.join(terms)}
          FROM timed GROUP BY {keys})"""


@query("rate_ewma", with_views(V_ACCESS, """
binned AS (SELECT app, uri, to_timestamp(epoch_us(ts) // 900000000 * 900)::TIMESTAMP AS w, ts FROM v_access)""",
       rate_sql("binned", "app, uri, w", "w + INTERVAL 15 MINUTE")) + """
SELECT app, uri, w, total, round(mean_rate, 6) AS mean_rate, round(m1_rate, 6) AS m1_rate,
       round(m5_rate, 6) AS m5_rate, round(m15_rate, 6) AS m15_rate FROM rated""")
def rate_ewma(spark, sf):
    binned = derived.access(spark, sf).withColumn("w", E.bucket_start(F.col("ts"), 900))
    out = metrics.rates(binned, ["app", "uri", "w"], "ts", F.col("w") + F.expr("INTERVAL 15 MINUTES"))
    return rounded(out, "mean_rate", "m1_rate", "m5_rate", "m15_rate", places=6)


@query("metric_name", ACCESS + """
SELECT DISTINCT 'app-uri' AS form, upper(app) || '-' || uri AS name FROM v_access
UNION ALL SELECT DISTINCT 'http', app || '-HTTP-' || http_code || '-' || uri FROM v_access WHERE http_code <> 200
UNION ALL SELECT DISTINCT 'biz', app || '-BIZ-CODE-' || biz_code || '-' || uri FROM v_access WHERE biz_code IS NOT NULL
UNION ALL SELECT DISTINCT 'cost', app || '-COST-' || uri FROM v_access WHERE cost_ms > 0""")
def metric_name(spark, sf):
    rows = derived.access(spark, sf)
    app, uri = F.col("app"), F.col("uri")
    def dash(text, column):
        return F.concat(F.lit(text), column.cast("string"), F.lit("-"))
    forms = F.array(
        F.struct(F.lit("app-uri").alias("form"), E.request_metric_name(F.upper(app), uri).alias("name")),
        F.struct(F.lit("http").alias("form"), F.when(F.col("http_code") != 200, E.request_metric_name(
            app, uri, dash("HTTP-", F.col("http_code")))).alias("name")),
        F.struct(F.lit("biz").alias("form"), E.request_metric_name(
            app, uri, dash("BIZ-CODE-", F.col("biz_code"))).alias("name")),
        F.struct(F.lit("cost").alias("form"), F.when(F.col("cost_ms") > 0, E.request_metric_name(
            app, uri, F.lit("COST-"))).alias("name")))
    return rows.select(F.inline(forms)).where("name is not null").distinct()


@query("access_parse", ACCESS + """
SELECT '10.0.0.' || user_id AS ip, date_trunc('second', ts) AS ts FROM v_access WHERE event_id % 7 <> 0""")
def access_parse(spark, sf):
    return parse.access_lines(derived.access_lines(derived.access(spark, sf)))


@query("dim_parse", """
SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS area FROM nation WHERE n_nationkey % 5 <> 0""")
def dim_parse(spark, sf):
    """Every fifth line carries a second dash and is dropped."""
    key = F.col("ip_key").cast("string")
    extra = F.when(F.col("ip_key") % 5 == 0, "-extra").otherwise("")
    lines = derived.areas(spark, sf).select(F.concat(key, F.lit("-"), "area", extra).alias("value"))
    return parse.dimension_lines(lines)


@query("geo_lookup", ACCESS + """
SELECT coalesce(n_name, '未知地域') AS area, count(*) AS total
FROM v_access LEFT JOIN nation ON n_nationkey = user_id % 40 GROUP BY ALL""")
def geo_lookup(spark, sf):
    rows = derived.access(spark, sf).select((F.col("user_id") % 40).alias("ip_key"))
    return metrics.counts(joins.area_lookup(rows, derived.areas(spark, sf), "ip_key"), ["area"])


@query("event_time_shift", ACCESS + "SELECT event_id, ts + INTERVAL 8 HOUR AS event_time FROM v_access")
def event_time_shift(spark, sf):
    return derived.access(spark, sf).select("event_id", E.shift_time(F.col("ts"), 8).alias("event_time"))


@query("time_format", ACCESS + """
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S.%g') || '+0800' AS shown,
       date_trunc('milliseconds', ts) AS as_millis FROM v_access""")
def time_format(spark, sf):
    rows = derived.access(spark, sf)
    micros = F.unix_micros("ts")
    return rows.select("event_id", E.display_time(E.epoch_micros_to_time(micros)).alias("shown"),
                       F.timestamp_millis(F.floor(micros / 1000)).alias("as_millis"))


@query("next_midnight", ACCESS + """
SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS midnight FROM v_access""")
def next_midnight(spark, sf):
    return derived.access(spark, sf).select("event_id", E.next_midnight(F.col("ts")).alias("midnight"))


@query("metric_report", ACCESS + """
, m AS (SELECT app || '-COST-' || uri AS name, CAST(count(*) AS DOUBLE) AS count, CAST(min(cost_ms) AS DOUBLE) AS min,
        CAST(max(cost_ms) AS DOUBLE) AS max, avg(cost_ms) AS mean, stddev_pop(cost_ms) AS stddev,
        quantile_cont(cost_ms, 0.5) AS p50, quantile_cont(cost_ms, 0.95) AS p95
        FROM v_access WHERE cost_ms > 0 GROUP BY 1)
SELECT name, 'histogram' AS type, 'host-1' AS host, TIMESTAMP '2024-02-01' AS report_time, field,
       round(value, 4) AS value
FROM (UNPIVOT m ON count, min, max, mean, stddev, p50, p95 INTO NAME field VALUE value)""")
def metric_report(spark, sf):
    summary = metrics.latency(derived.access(spark, sf), ["app", "uri"], "cost_ms", True, (0.5, 0.95), 1000)
    rows = metrics.report_rows(
        summary.withColumnRenamed("n", "count"), E.request_metric_name(F.col("app"), F.col("uri"), F.lit("COST-")),
        "histogram", ["count", "min", "max", "mean", "stddev", "p50", "p95"], "host-1",
        F.lit("2024-02-01 00:00:00").cast("timestamp"))
    return rounded(rows, "value")


@query("count_per_element", ACCESS + "SELECT uri AS element, count(*) AS n FROM v_access GROUP BY ALL")
def count_per_element(spark, sf):
    return metrics.counts(derived.access(spark, sf), [F.col("uri").alias("element")], "n")
