"""Alarm queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.functions import conditions, expressions as E
from tracewell.operators import alarms, metrics, search
from tracewell.plans.panels import HIT, kept
from tracewell.plans.registry import query
from tracewell.plans.requests import rate_sql
from tracewell.plans.spans import KEPT, normalized
from tracewell.plans.sql_views import RULE_MATCH, V_NORM, V_SPAN, v_alarm, with_views
from tracewell.sources import derived

NOW, START = "2024-03-01 00:15:00", "2024-02-29 22:00:00"
START_SECONDS = 1709244000
TICK = 60
LISTED = with_views(v_alarm("customer", "c_custkey"))


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules to evaluate: one per nation."""
    return derived.rules(derived.table(spark, sf, "nation"), "n_nationkey")


def listed_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Rules to list and search: one per customer."""
    return derived.rules(derived.table(spark, sf, "customer"), "c_custkey").withColumn(
        "enable", F.col("enable").cast("int"))


@query("alarm_enabled", LISTED + "SELECT id, title FROM v_alarm WHERE enable = 1")
def alarm_enabled(spark, sf):
    return alarms.enabled(listed_rules(spark, sf), 1).select("id", "title")


@query("alarm_page", LISTED + "SELECT id, title, enable FROM v_alarm WHERE enable = 1 ORDER BY id LIMIT 20 OFFSET 20")
def alarm_page(spark, sf):
    found = alarms.enabled(listed_rules(spark, sf), 1).select("id", "title", "enable")
    return search.page(found, [F.asc("id")], 1, 20)


@query("distinct_by_title", LISTED + """
SELECT title, min(id) AS id, arg_min(threshold, id) AS threshold FROM v_alarm GROUP BY title ORDER BY title LIMIT 20""")
def distinct_by_title(spark, sf):
    rows = listed_rules(spark, sf).select("title", "id", "threshold")
    return search.page(search.distinct_by(rows, "title", "id"), [F.asc("title")])


@query("distinct_titles_total", LISTED + """
SELECT count(DISTINCT title) AS titles, count(*) AS documents FROM v_alarm""")
def distinct_titles_total(spark, sf):
    per_title = listed_rules(spark, sf).groupBy("title").agg(F.count("*").alias("n"))
    return per_title.agg(F.count("*").alias("titles"), F.sum("n").alias("documents"))


@query("rule_upsert", LISTED + """
SELECT id % 500 AS id, arg_max(title, id) AS title, arg_max(threshold, id) AS threshold, max(id) AS version
FROM v_alarm GROUP BY 1""")
def rule_upsert(spark, sf):
    written = listed_rules(spark, sf).select(
        (F.col("id") % 500).alias("id"), "title", "threshold", F.col("id").alias("version"))
    return alarms.upsert(written, "version")


ALARM = with_views(V_SPAN, V_NORM, KEPT, v_alarm("nation", "n_nationkey"))
MATCHED = f""", m AS (SELECT r.id AS rule_id, r.frequency, r.throttle, r.threshold, h.* FROM v_trace_hit h JOIN v_alarm r
  ON r.enable = 1 AND {RULE_MATCH})"""
ORDER = "create_time DESC, duration DESC, trace_id, span_id, row_key"


@query("alarm_match", ALARM + MATCHED + f"""
SELECT rule_id, rank, trace_id, span_id, row_key, type, create_time FROM (
  SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY {ORDER}) AS rank FROM m
  WHERE create_time >= TIMESTAMP '{NOW}' - to_seconds(frequency) AND create_time <= TIMESTAMP '{NOW}') WHERE rank <= 20""")
def alarm_match(spark, sf):
    found = alarms.match(kept(spark, sf), rules(spark, sf), NOW)
    return found.select("rule_id", "rank", "trace_id", "span_id", "row_key", "type", "create_time")


@query("alarm_test", HIT + f"""
SELECT app, type, trace_id, span_id, row_key, duration, create_time FROM v_trace_hit
WHERE type = 'COST' AND duration >= 3000000 ORDER BY {ORDER} LIMIT 20""")
def alarm_test(spark, sf):
    condition = '{"range":{"span.duration":{"gte":3000000}}},{"term":{"type":"COST"}}'
    order = [F.desc("create_time"), F.desc("duration"), F.asc("trace_id"), F.asc("span_id"), F.asc("row_key")]
    found = kept(spark, sf).where(conditions.predicate(condition))
    return search.page(found, order).select("app", "type", "trace_id", "span_id", "row_key", "duration", "create_time")


TICKS = MATCHED + f""",
timed AS (SELECT *, epoch_us(create_time) // 1000000 AS t, CAST(ceil(frequency / {TICK}.0) AS BIGINT) * {TICK} AS period FROM m),
firsts AS (SELECT *, {START_SECONDS} + CAST(ceil((t - {START_SECONDS}) / CAST(period AS DOUBLE)) AS BIGINT) * period AS f FROM timed),
ticks AS (SELECT rule_id, throttle, threshold, tick, count(*) AS matches FROM firsts,
          LATERAL (SELECT unnest(generate_series(f, t + frequency, period)) AS tick) GROUP BY ALL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY tick) AS rn FROM ticks),
fold AS (
  SELECT rule_id, rn, tick, matches, tick AS opened, CAST(1 AS BIGINT) AS n, false AS fired FROM numbered WHERE rn = 1
  UNION ALL
  SELECT k.rule_id, k.rn, k.tick, k.matches, CASE WHEN o THEN k.tick ELSE f.opened END,
         CASE WHEN o THEN 1 ELSE f.n + 1 END, NOT o AND k.threshold <= f.n
  FROM fold f JOIN numbered k ON k.rule_id = f.rule_id AND k.rn = f.rn + 1,
       LATERAL (SELECT k.tick - f.opened >= k.throttle AS o))"""


def fired(spark: SparkSession, sf: str) -> DataFrame:
    ticks = alarms.match_ticks(kept(spark, sf), rules(spark, sf), START, TICK)
    return alarms.throttle(ticks)


@query("alarm_throttle", ALARM + TICKS + "SELECT rule_id, tick, matches, CAST(fired AS INT) AS fired FROM fold")
def alarm_throttle(spark, sf):
    return fired(spark, sf).withColumn("fired", F.col("fired").cast("int"))


@query("alarm_events", ALARM + TICKS + """
SELECT rule_id, count(*) AS fired, min(tick) AS first_tick, max(tick) AS last_tick, CAST(sum(matches) AS BIGINT) AS matches
FROM fold WHERE fired GROUP BY ALL""")
def alarm_events(spark, sf):
    """Fired alarms summed up per rule: schedule, match and throttle together."""
    return fired(spark, sf).where("fired").groupBy("rule_id").agg(
        F.count("*").alias("fired"), F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"),
        F.sum("matches").alias("matches"))


@query("alarm_actions", ALARM + TICKS + """
, acts AS (SELECT id, title, 'EMAIL' AS type, 'user' || id || '@example.com' AS receiver FROM v_alarm WHERE id % 2 = 0
           UNION ALL SELECT id, title, 'SMS', CAST(id AS VARCHAR) FROM v_alarm WHERE id % 2 = 0
           UNION ALL SELECT id, title, 'DEFAULT', CAST(id AS VARCHAR) FROM v_alarm WHERE id % 2 = 1)
SELECT rule_id, title, tick, type, receiver FROM fold JOIN acts ON id = rule_id WHERE fired""")
def alarm_actions(spark, sf):
    return alarms.actions(fired(spark, sf).where("fired"), rules(spark, sf)).select(
        "rule_id", "title", "tick", "type", "receiver")


@query("alarm_schedule", with_views("""
ticks AS (SELECT user_id % 10 AS rule_id, epoch_us(ts) // 60000000 * 60 AS tick,
          max(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS on_flag FROM events GROUP BY ALL),
n AS (SELECT *, 600 * (rule_id + 1) AS frequency, row_number() OVER (PARTITION BY rule_id ORDER BY tick) AS rn FROM ticks),
fold AS (
  SELECT rule_id, rn, tick, on_flag = 1 AS runs, CASE WHEN on_flag = 1 THEN tick + frequency END AS due FROM n WHERE rn = 1
  UNION ALL
  SELECT n.rule_id, n.rn, n.tick, n.on_flag = 1 AND (f.due IS NULL OR n.tick >= f.due),
         CASE WHEN n.on_flag = 0 THEN NULL WHEN f.due IS NULL OR n.tick >= f.due THEN n.tick + n.frequency ELSE f.due END
  FROM fold f JOIN n ON n.rule_id = f.rule_id AND n.rn = f.rn + 1)""") + "SELECT rule_id, tick FROM fold WHERE runs")
def alarm_schedule(spark, sf):
    """Rule switches and evaluation minutes taken from the event table."""
    events = derived.table(spark, sf, "events")
    ticks = events.groupBy((F.col("user_id") % 10).alias("rule_id"),
                           (F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 60) * 60).alias("tick")).agg(
        F.max(F.when(F.col("event_type") == "error", False).otherwise(True)).alias("on"))
    return alarms.schedule(ticks.withColumn("frequency", 600 * (F.col("rule_id") + 1)))


FIVES = with_views(V_SPAN, V_NORM, """
binned AS (SELECT app, metric_kind, name, to_timestamp(epoch_us(ts) // 300000000 * 300)::TIMESTAMP AS w, ts FROM v_norm)""",
                   rate_sql("binned", "app, metric_kind, name, w", "w + INTERVAL 5 MINUTE", (5,))) + """
, q AS (SELECT app, metric_kind, name, epoch_us(w) // 1000000 AS t, round(m5_rate, 6) AS v FROM rated)"""
ENDPOINT = ["app", "metric_kind", "name"]


def fives(spark: SparkSession, sf: str) -> DataFrame:
    """Moving rate of each endpoint at the end of every five minutes in which it was called."""
    binned = normalized(spark, sf).withColumn("w", E.bucket_start(F.col("ts"), 300))
    rated = metrics.rates(binned, [*ENDPOINT, "w"], "ts", F.col("w") + F.expr("INTERVAL 5 MINUTES"), (5,))
    return rated.select(*ENDPOINT, F.unix_seconds("w").alias("t"), F.round("m5_rate", 6).alias("v"))


@query("qps_max_ttl", FIVES + """
, n AS (SELECT *, row_number() OVER (PARTITION BY app, metric_kind, name ORDER BY t) AS rn FROM q),
fold AS (
  SELECT app, metric_kind, name, rn, t, v, v AS v_max, t AS since FROM n WHERE rn = 1
  UNION ALL
  SELECT n.app, n.metric_kind, n.name, n.rn, n.t, n.v, CASE WHEN s THEN n.v ELSE f.v_max END, CASE WHEN s THEN n.t ELSE f.since END
  FROM fold f JOIN (SELECT *, true AS one FROM n) n ON n.app = f.app AND n.metric_kind IS NOT DISTINCT FROM f.metric_kind AND n.name = f.name AND n.rn = f.rn + 1,
       LATERAL (SELECT n.t >= f.since + 900 OR n.v > f.v_max AS s))
SELECT app, metric_kind, name, t, v, v_max FROM fold""")
def qps_max_ttl(spark, sf):
    """Five-minute rates with a maximum that lives for a quarter hour."""
    return metrics.largest_alive(fives(spark, sf), ENDPOINT, "t", "v", 900)


@query("qps_max_15m", FIVES + """
SELECT app, metric_kind, name, t, v, max(v) OVER (PARTITION BY app, metric_kind, name ORDER BY t RANGE BETWEEN 900 PRECEDING AND CURRENT ROW) AS v_max FROM q""")
def qps_max_15m(spark, sf):
    return search.sliding_max(fives(spark, sf), ENDPOINT, "t", "v", 900)
