"""Queries over sources, sinks and streams. Streams run over what is available and return their table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tracewell.functions import expressions as E
from tracewell.operators import alarms, parse, spans as S, topology
from tracewell.plans.alarms import ALARM, START, TICK, TICKS, rules
from tracewell.plans.panels import HIT, kept
from tracewell.plans.registry import query
from tracewell.plans.requests import ACCESS, rate_sql, rounded
from tracewell.plans.spans import DECODED_SQL, SPAN, decoded_columns, messages
from tracewell.plans.sql_views import V_ACCESS, V_NORM, V_SPAN, with_views
from tracewell.plans.topology import LINKS, URL_CALLS, calls
from tracewell.session import discard, new_path, short_shuffles, stage
from tracewell.sinks import writers
from tracewell.sources import derived, readers
from tracewell.streaming import panes as fired_panes, rules as stream_rules, runs, stateful, summaries, traces, windows


def access_stream(spark: SparkSession, sf: str) -> DataFrame:
    return derived.access_columns(readers.read_table_stream(derived.prepare(spark), sf, "events"))


def span_stream(spark: SparkSession, sf: str) -> DataFrame:
    return derived.span_columns(readers.read_table_stream(derived.prepare(spark), sf, "lineitem"))


def _app_uri():
    return F.concat_ws("-", F.upper("app"), "uri")


def _tumbling(seconds: int) -> str:
    us = seconds * 1_000_000
    return f"to_timestamp(epoch_us(ts) // {us} * {seconds})::TIMESTAMP"


# --- sources

LINE = """'10.0.0.' || user_id || ' - - ' || CASE WHEN event_id % 7 = 0 THEN '[broken line]' ELSE
strftime(ts, '[%Y-%m-%d %H:%M:%S]') END || ' "GET ' || uri || ' HTTP/1.1" ' || http_code || ' ' || cost_ms"""


@query("src_text", ACCESS + f"SELECT {LINE} AS value FROM v_access")
def src_text(spark, sf):
    path = new_path(spark, "lines")
    derived.access_lines(derived.access(spark, sf)).write.text(path)
    return readers.read_lines(spark, path)


@query("src_jsonl", ACCESS + "SELECT upper(app) AS app, uri, http_code, cost_ms FROM v_access")
def src_jsonl(spark, sf):
    path = new_path(spark, "jsonl")
    derived.envelopes(derived.access(spark, sf)).select("value").write.text(path)
    followed = readers.read_json_lines(spark, path).select(F.to_json(F.struct("*")).alias("value"))
    return runs.run_to_table(parse.request_logs(followed).select("app", "uri", "http_code", "cost_ms")).drop("batch")


@query("src_topic_replay", ACCESS + "SELECT CAST(event_id AS VARCHAR) AS key, uri, http_code FROM v_access")
def src_topic_replay(spark, sf):
    path = new_path(spark, "topic")
    logs = derived.envelopes(derived.access(spark, sf))
    writers.write_topic_dump(writers.topic_rows(logs, F.col("event_id"), F.col("value")), path, "request-log")
    stream = readers.read_topic_dump(spark, path, ["request-log", "other"])
    return runs.run_to_table(parse.request_logs(stream).select("key", "uri", "http_code")).drop("batch")


@query("src_span_file", SPAN + DECODED_SQL + "l_partkey % 50 NOT IN (0, 2, 4, 5, 6)")
def src_span_file(spark, sf):
    path = new_path(spark, "spanfile")
    messages(spark, sf).select("value").write.text(path)
    return decoded_columns(parse.span_arrays_tolerant(readers.read_lines(spark, path)))


@query("scan_results", ACCESS + """
SELECT event_id, uri, cost_ms FROM v_access
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AND http_code = 500""")
def scan_results(spark, sf):
    """A daily result table read back for some of its days."""
    path = new_path(spark, "results")
    writers.write_daily(derived.access(spark, sf), path, "ts")
    return readers.read_results(spark, path, F.col("http_code") == 500, "2024-01-10", "2024-01-19").select(
        "event_id", "uri", "cost_ms")


# --- sinks

def uri_totals(spark: SparkSession, sf: str) -> DataFrame:
    return windows.running_counts(derived.access(spark, sf), _app_uri())


@query("sink_topic", ACCESS + """
SELECT upper(app) || '-' || uri AS key, CAST(count(*) AS VARCHAR) AS value FROM v_access GROUP BY 1""")
def sink_topic(spark, sf):
    path = new_path(spark, "topic")
    writers.write_topic_dump(writers.topic_rows(uri_totals(spark, sf), F.col("key"), F.col("n")), path, "uri-count")
    return spark.read.parquet(path).select("key", "value")


@query("sink_value", ACCESS + """
SELECT upper(app) || '-' || uri || ': ' || count(*) AS value FROM v_access GROUP BY app, uri""")
def sink_value(spark, sf):
    path = new_path(spark, "values")
    writers.value_rows(uri_totals(spark, sf), F.col("key"), F.col("n"), ": ").write.text(path)
    return spark.read.text(path)


@query("sink_daily", ACCESS + """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_id, uri FROM v_access""")
def sink_daily(spark, sf):
    path = new_path(spark, "daily")
    writers.write_daily(derived.access(spark, sf).select("event_id", "uri", "ts"), path, "ts", "json")
    return spark.read.schema("event_id long, uri string, ts timestamp, day date").json(path).select(
        F.col("day").cast("timestamp").alias("day"), "event_id", "uri")


@query("sink_per_window", ACCESS + """
SELECT strftime(to_timestamp(epoch_us(ts) // 86400000000 * 86400)::TIMESTAMP, '%Y%m%d-%H%M') AS w_start,
       strftime(to_timestamp(epoch_us(ts) // 86400000000 * 86400 + 86400)::TIMESTAMP, '%Y%m%d-%H%M') AS w_end, event_id || ' ' || uri AS line FROM v_access""")
def sink_per_window(spark, sf):
    path = new_path(spark, "windows")
    line = F.concat_ws(" ", F.col("event_id").cast("string"), "uri")
    writers.write_per_window(derived.access(spark, sf), path, "ts", 86_400, 3, line)
    return spark.read.schema("value string, w_start string, w_end string, shard int").text(path).select("w_start", "w_end", F.col("value").alias("line"))


@query("sink_shards", ACCESS + "SELECT uri AS line, count(*) AS lines, 4 AS files FROM v_access GROUP BY uri")
def sink_shards(spark, sf):
    path = new_path(spark, "shards")
    writers.write_shards(derived.access(spark, sf), path, 4, F.col("uri"))
    lines = spark.read.text(path).select(F.col("value").alias("line"), F.input_file_name().alias("f"))
    return lines.groupBy("line").agg(F.count("*").alias("lines")).withColumn("files", F.lit(lines.select("f").distinct().count()))


@query("sink_snapshot", ACCESS + "SELECT upper(app) || '-' || uri AS key, count(*) AS n FROM v_access GROUP BY 1")
def sink_snapshot(spark, sf):
    """Writing an interval twice leaves it once."""
    path = new_path(spark, "snapshot")
    rows = uri_totals(spark, sf)
    for _ in range(2):
        writers.write_snapshot(rows, path, "2024-02-01", "0015")
    return spark.read.parquet(path).select("key", "n")


@query("sink_fanout", ACCESS + """
SELECT sink, event_id, uri, cost_ms FROM v_access, (SELECT unnest(['a', 'b']) AS sink)""")
def sink_fanout(spark, sf):
    """Every request of a stream in both of two sinks."""
    a, b = new_path(spark, "fan-a"), new_path(spark, "fan-b")
    runs.run_available(access_stream(spark, sf), writers.fan_out(writers.by_batch(a), writers.by_batch(b)))
    got = [spark.read.parquet(path).select(F.lit(name).alias("sink"), "event_id", "uri", "cost_ms") for path, name in ((a, "a"), (b, "b"))]
    return got[0].unionByName(got[1])


@query("stream_insert_absent", HIT + """
SELECT CAST(date_trunc('day', create_time) AS TIMESTAMP) AS day, app, type, trace_id, span_id, arg_min(duration, (create_time, row_key)) AS duration
FROM v_trace_hit GROUP BY ALL""")
def stream_insert_absent(spark, sf):
    """Kept traces inserted by a stream into daily tables that already hold some of them."""
    table, hits = new_path(spark, "kept"), stage(kept(spark, sf), "hits")
    writers.insert_absent(table, "create_time")(hits.where("create_time < TIMESTAMP '2024-02-29 23:30:00'"), -1)
    runs.run_available(replayed_in_order(hits, "create_time"), writers.insert_absent(table, "create_time"))
    stored = spark.read.parquet(table)
    return stored.select(F.col("day").cast("timestamp").alias("day"), "app", "type", "trace_id", "span_id", "duration")


# --- change data

CDC = """c AS (SELECT CAST(o_orderkey AS VARCHAR) AS msg_key, 'db' AS database, 'orders' AS table_name,
  CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPDATE' ELSE 'DELETE' END AS action, o_custkey, o_orderstatus,
  o_orderdate FROM orders WHERE o_orderkey % 100 <> 0)"""


@query("cdc_decode", with_views(CDC) + """
SELECT msg_key, database, table_name, action, 'o_orderkey' AS primary_key, CAST(o_custkey AS VARCHAR) AS custkey,
       CASE WHEN o_orderstatus = 'F' THEN 'o_custkey,o_orderstatus' END AS updated, o_orderdate AS executed, o_orderdate AS received FROM c""")
def cdc_decode(spark, sf):
    rows = parse.change_records(derived.cdc(spark, sf))
    return rows.select("msg_key", "database", "table_name", "action", F.array_join("primary_key", ",").alias("primary_key"),
                       F.col("fields")["o_custkey"].alias("custkey"),
                       F.array_join("updated", ",").alias("updated"), "executed", "received")


@query("cdc_relay", with_views(CDC) + "SELECT msg_key AS key, action, CAST(o_custkey AS VARCHAR) AS custkey FROM c")
def cdc_relay(spark, sf):
    """Change records read as a stream, re-keyed and relayed as JSON into the table of the day they arrive."""
    raw = derived.cdc_messages(readers.read_table_stream(derived.prepare(spark), sf, "orders"))
    records = parse.change_records(raw)
    relayed = parse.keyed_json(records, F.col("msg_key")).withColumn("arrived", F.current_timestamp())
    path = new_path(spark, "relay")
    runs.run_available(relayed, writers.daily_by_batch(path, "arrived"))
    return spark.read.parquet(path).select(
        "key", F.get_json_object("value", "$.action").alias("action"),
        F.get_json_object("value", "$.fields.o_custkey").alias("custkey"))


# --- windows

@query("win_tumbling_10s", ACCESS + f"""
SELECT {_tumbling(10)} AS w_start, upper(app) || '-' || uri AS key, CAST(count(*) AS VARCHAR) AS value FROM v_access GROUP BY 1, 2""")
def win_tumbling_10s(spark, sf):
    counted = windows.windowed_counts(access_stream(spark, sf), "ts", _app_uri(), "10 seconds", late="1 hour")
    done = runs.latest(runs.run_to_table(counted, "update"), ["w_start", "w_end", "key"])
    return done.select("w_start", "key", F.col("n").cast("string").alias("value"))


@query("win_fixed_5s", ACCESS + f"SELECT {_tumbling(5)} AS w_start, uri AS key, count(*) AS n FROM v_access GROUP BY 1, 2")
def win_fixed_5s(spark, sf):
    counted = windows.windowed_counts(access_stream(spark, sf), "ts", F.col("uri"), "5 seconds", late="1 hour")
    return runs.latest(runs.run_to_table(counted, "update"), ["w_start", "w_end", "key"]).select("w_start", "key", "n")


def _sliding(width: int, slide: int) -> str:
    return f""", w AS (SELECT *, unnest(generate_series(0, {width // slide - 1})) AS i FROM v_access)
SELECT to_timestamp(epoch_us(ts) // {slide * 1_000_000} * {slide} - i * {slide})::TIMESTAMP AS w_start, uri AS key,
       count(*) AS n FROM w GROUP BY 1, 2"""


@query("win_sliding_60_5", ACCESS + _sliding(60, 5))
def win_sliding_60_5(spark, sf):
    return windows.windowed_counts(derived.access(spark, sf), "ts", F.col("uri"), "60 seconds", "5 seconds").select(
        "w_start", "key", "n")


@query("win_sliding_late", ACCESS + _sliding(15, 5))
def win_sliding_late(spark, sf):
    """Update mode re-emits a window's whole count; the last emission per window is its result."""
    counted = windows.windowed_counts(access_stream(spark, sf), "ts", F.col("uri"), "15 seconds", "5 seconds", "30 seconds", panes=False)
    return runs.latest(runs.run_to_table(counted, "update"), ["w_start", "w_end", "key"]).select("w_start", "key", "n")


@query("stream_fired_counts", ACCESS + _sliding(15, 5))
def stream_fired_counts(spark, sf):
    """The same windows by a processor that fires early, on time and after three late rows; a window's largest count is its last."""
    rows = replayed_in_order(derived.access(spark, sf), "ts")
    fired = runs.run_to_table(fired_panes.fired_counts(rows, "ts", F.col("uri"), 15, 5, 30))
    return fired.groupBy("w_start", "key").agg(F.max("n").alias("n"))


@query("running_count", ACCESS + "SELECT upper(app) || '-' || uri AS key, count(*) AS n FROM v_access GROUP BY 1")
def running_count(spark, sf):
    written = runs.run_to_table(windows.running_counts(access_stream(spark, sf), _app_uri()), "complete")
    return runs.latest(written, ["key"])


# --- stateful

LATENESS = "45 minutes"

# sessions of a trace end where sixteen minutes pass without a span; closed are those that the watermark has passed by as much
CLOSED = """marked AS (SELECT *, coalesce(ts >= lag(ts) OVER w + INTERVAL 16 MINUTE, true) AS opens FROM v_span
  WINDOW w AS (PARTITION BY trace_id ORDER BY ts)),
counted AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY trace_id ORDER BY ts) AS nr FROM marked),
bounded AS (SELECT *, min(ts) OVER s AS s_start, max(ts) OVER s AS s_end FROM counted WINDOW s AS (PARTITION BY trace_id, nr)),
day_span AS (SELECT * EXCLUDE (opens, nr, s_start, s_end) REPLACE (trace_id || '@' || strftime(s_start, '%Y%m%d%H%M%S%f') AS trace_id) FROM bounded
  WHERE s_end + INTERVAL 61 MINUTE <= (SELECT max(ts) FROM v_span))"""


REPLAY_ROWS, REPLAY_FILES = 200_000, 64     # rows of a file, and files of a micro-batch at most


def replay(rows: DataFrame, at: Column, stretches: int, schema: StructType) -> DataFrame:
    """Rows as a stream with a micro-batch for each of ``stretches`` equal stretches of ``at``, in this order.

    A long stretch is written by several tasks; every stretch gets the same number of files, some of them empty, as a micro-batch takes a fixed number.
    """
    spark, path = rows.sparkSession, new_path(rows.sparkSession, "replay")
    first, last = rows.agg(F.min(at), F.max(at)).first()
    width = (last - first) // stretches + 1
    number = F.floor((at - first) / F.lit(width)).cast("int")
    sizes = {r["k"]: r["n"] for r in rows.groupBy(number.alias("k")).agg(F.count("*").alias("n")).where("k IS NOT NULL").collect()}
    files = min(REPLAY_FILES, max(1, max(sizes.values()) // REPLAY_ROWS))
    none = spark.createDataFrame([], schema).coalesce(1)
    for k in range(stretches):
        own = rows.where((at >= first + k * width) & (at < first + (k + 1) * width)).select(*schema.names)
        many = min(files, sizes.get(k, 0) // REPLAY_ROWS)
        with short_shuffles(spark):
            (own.repartition(many) if many > 1 else own.coalesce(1)).write.mode("append").parquet(path)
        for _ in range(files - max(many, 1)):
            none.write.mode("append").parquet(path)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def replayed_spans(spark: SparkSession, sf: str, files: int = 6) -> DataFrame:
    """Spans as a stream of ``files`` micro-batches: spans arrive half an hour early or late, and a few arrive twice."""
    spans = derived.spans(spark, sf)
    delay = F.pmod(F.xxhash64("trace_id", "span_id", "row_key"), F.lit(1_800)) + 900 * (F.pmod(F.xxhash64("row_key"), F.lit(2)))
    arrivals = spans.withColumn("_at", F.unix_seconds("ts") + delay)
    again = arrivals.where(F.pmod(F.xxhash64("trace_id", "row_key"), F.lit(40)) == 0).withColumn("_at", F.col("_at") + 60)
    every = stage(arrivals.unionByName(again), "arrivals")
    stream = replay(every, F.col("_at"), files, spans.schema)
    discard(every)
    return stream


def assembled_traces(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every span of the replay, as a table."""
    return runs.run_to_table(traces.assemble(replayed_spans(spark, sf), LATENESS))


def closed_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of closed trace sessions, each session under a name of its own."""
    named = F.concat("trace_id", F.lit("@"), F.date_format("session_start", "yyyyMMddHHmmssSSSSSS"))
    return assembled_traces(spark, sf).where(F.col("outcome") == traces.CLOSED).withColumn("trace_id", named).drop(
        "outcome", "times", "session_start", "session_end", "batch")


@query("stream_traces", with_views(V_SPAN, CLOSED) + """
SELECT trace_id, span_id, row_key, ts, duration FROM day_span""")
def stream_traces(spark, sf):
    return closed_spans(spark, sf).select("trace_id", "span_id", "row_key", "ts", "duration")


@query("stream_topology", with_views(V_SPAN, CLOSED, V_NORM.replace("FROM v_span", "FROM day_span"), URL_CALLS + LINKS) + """
SELECT trace_id, parent, child, call_count, error_count, round(cost, 4) AS cost FROM links""")
def stream_topology(spark, sf):
    """Closed trace sessions turned into links with the batch operators, micro-batch by micro-batch."""
    path = new_path(spark, "links")
    to_path = writers.by_batch(path)
    named = F.concat("trace_id", F.lit("@"), F.date_format("session_start", "yyyyMMddHHmmssSSSSSS"))

    def write(batch: DataFrame, batch_id: int) -> None:
        closed = stage(batch.where(F.col("outcome") == traces.CLOSED).withColumn("trace_id", named).drop("outcome", "times", "session_start", "session_end"), "closed")
        if not closed.isEmpty():
            to_path(topology.trace_links(topology.linked_calls(S.normalize(closed))), batch_id)
        discard(closed)
    runs.run_available(traces.assemble(replayed_spans(spark, sf), LATENESS), write)
    return rounded(spark.read.parquet(path).select(
        "trace_id", "parent", "child", "call_count", "error_count", "cost"), "cost")


def replayed_in_order(rows: DataFrame, ts: str, files: int = 5) -> DataFrame:
    """Rows as a stream of ``files`` micro-batches, one for each stretch of time."""
    return replay(rows, F.unix_micros(ts), files, rows.schema)


@query("stream_kept_traces", HIT + "SELECT * FROM v_trace_hit")
def stream_kept_traces(spark, sf):
    """Failed and slow spans of a stream, by moments that go on from micro-batch to micro-batch."""
    path = new_path(spark, "kept")
    spans = S.normalize(derived.spans(spark, sf)).select("trace_id", "span_id", "row_key", "name", "duration", "ts", "app", "metric_kind", "tags")
    runs.run_available(replayed_in_order(spans, "ts"), summaries.keep_traces(new_path(spark, "moments"), writers.by_batch(path)))
    return spark.read.parquet(path).drop("batch")


@query("stream_snapshot_15m", with_views(V_ACCESS) + """
, b AS (SELECT *, to_timestamp(epoch_us(ts) // 900000000 * 900)::TIMESTAMP AS w FROM v_access),
c AS (SELECT app, uri, w, count(*) AS total FROM b GROUP BY ALL)
SELECT c.app, c.uri, c.w, c.total, count(*) AS n, min(cost_ms) AS min, max(cost_ms) AS max,
       round(avg(cost_ms), 4) AS mean, round(quantile_cont(cost_ms, 0.95), 4) AS p95, round(quantile_cont(cost_ms, 0.99), 4) AS p99
FROM c JOIN b ON b.app = c.app AND b.uri = c.uri AND date_trunc('day', b.ts) = date_trunc('day', c.w)
     AND b.ts < c.w + INTERVAL 15 MINUTE
WHERE c.w + INTERVAL 45 MINUTE <= (SELECT max(ts) FROM v_access) GROUP BY ALL""")
def stream_snapshot_15m(spark, sf):
    """The quarter-hour snapshots of a stream, each given out when its interval has ended half an hour ago."""
    path, keys = new_path(spark, "snapshots"), ["app", "uri"]
    rows = replayed_in_order(derived.access(spark, sf), "ts")
    closed = summaries.closed_histograms(rows, keys, "ts", "cost_ms", late="30 minutes")
    runs.run_available(closed, summaries.snapshot_writer(new_path(spark, "history"), writers.by_batch(path), keys, (0.95, 0.99)))
    return rounded(spark.read.parquet(path).drop("batch"), "mean", "p95", "p99")


@query("stream_rates", with_views(V_ACCESS, """
binned AS (SELECT app, uri, to_timestamp(epoch_us(ts) // 900000000 * 900)::TIMESTAMP AS w, ts FROM v_access)""",
       rate_sql("binned", "app, uri, w", "w + INTERVAL 15 MINUTE")) + """
SELECT app, uri, w, total, round(mean_rate, 6) AS mean_rate, round(m1_rate, 6) AS m1_rate,
       round(m5_rate, 6) AS m5_rate, round(m15_rate, 6) AS m15_rate FROM rated
WHERE w + INTERVAL 45 MINUTE <= (SELECT max(ts) FROM v_access)""")
def stream_rates(spark, sf):
    """Moving rates of a stream by quarter hours, each given out when its interval has ended half an hour ago."""
    path = new_path(spark, "rates")
    rows = derived.access(spark, sf).select("app", "uri", "ts", E.bucket_start(F.col("ts"), 900).alias("w"))
    writer = summaries.rate_writer(new_path(spark, "decayed"), writers.by_batch(path), ["app", "uri", "w"], "ts", F.col("w") + F.expr("INTERVAL 15 MINUTES"), 1_800)
    runs.run_available(replayed_in_order(rows, "ts"), writer)
    return rounded(spark.read.parquet(path).drop("batch"), "mean_rate", "m1_rate", "m5_rate", "m15_rate", places=6)


@query("stream_win_links", with_views(V_SPAN, V_NORM, URL_CALLS) + """
SELECT w AS w_start, parent || '|' || child AS key, count(*) AS n
FROM calls, LATERAL (SELECT unnest(generate_series(0, 2)) AS i),
     LATERAL (SELECT to_timestamp(epoch_us(ts) // 300000000 * 300 - i * 300)::TIMESTAMP AS w)
WHERE w + INTERVAL 45 MINUTE <= (SELECT max(ts) FROM calls) GROUP BY ALL""")
def stream_win_links(spark, sf):
    """Call links of a stream counted in 15-minute windows sliding by five minutes, each given out half an hour after its end."""
    made = stage(calls(spark, sf, columns=("ts", "parent", "child")), "calls")
    counted = windows.windowed_counts(replayed_in_order(made, "ts"), "ts", F.concat_ws("|", "parent", "child"), "15 minutes", "5 minutes", "30 minutes")
    return runs.run_to_table(counted).select("w_start", "key", "n")


@query("stream_alarms", ALARM + TICKS + "SELECT rule_id, tick, matches, CAST(fired AS INT) AS fired FROM fold")
def stream_alarms(spark, sf):
    """Alarm throttling as a stream over the rules' matches."""
    path = new_path(spark, "matches")
    ticks = alarms.match_ticks(kept(spark, sf), rules(spark, sf), START, TICK)
    ticks.write.parquet(path)
    schema = spark.read.parquet(path).schema
    fired = stateful.throttle_stream(spark.readStream.schema(schema).parquet(path))
    return runs.run_to_table(fired, "update").select("rule_id", "tick", "matches", F.col("fired").cast("int").alias("fired"))


def rule_events(spark: SparkSession, sf: str) -> DataFrame:
    """Stream of rule definitions, then of matched hits in time order, then of a beat after the last run."""
    path = new_path(spark, "rule-events")
    known = rules(spark, sf)
    known.transform(lambda r: stream_rules.rule_changes(r, START)).coalesce(1).write.parquet(path)
    hits = stage(kept(spark, sf), "hits")
    to_events: writers.BatchWriter = lambda events, batch_id: events.coalesce(1).write.mode("append").parquet(path)
    runs.run_available(replayed_in_order(hits, "create_time"), stream_rules.match_writer(lambda batch_id: known, to_events))
    spark.sql("SELECT CAST(NULL AS BIGINT) AS rule_id, 'beat' AS kind, TIMESTAMP '2024-03-02' AS at").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(stream_rules.EVENT).option("maxFilesPerTrigger", 1).parquet(path)


@query("stream_alarm_events", ALARM + TICKS + """
SELECT rule_id, count(*) AS fired, min(tick) AS first_tick, max(tick) AS last_tick, CAST(sum(matches) AS BIGINT) AS matches
FROM fold WHERE fired GROUP BY ALL""")
def stream_alarm_events(spark, sf):
    """Fired alarms summed up per rule; rules run by timers on a stream of hits."""
    done = runs.run_to_table(stream_rules.run_rules(rule_events(spark, sf), TICK))
    return done.where("fired").groupBy("rule_id").agg(
        F.count("*").alias("fired"), F.min("tick").alias("first_tick"), F.max("tick").alias("last_tick"), F.sum("matches").alias("matches"))
