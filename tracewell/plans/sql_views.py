"""SQL text of the derived views, for checking results against another engine."""

V_ACCESS = r"""v_access AS (
  SELECT event_id, ts, 'app' || (user_id % 5) AS app, '/' || event_type || '/' || (user_id % 7) AS uri,
         CAST(floor(value) AS BIGINT) AS cost_ms,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS http_code,
         CASE WHEN CAST(regexp_extract(props, '(\d+)', 1) AS INT) % 5 <> 0
              THEN 'C' || (CAST(regexp_extract(props, '(\d+)', 1) AS INT) % 4) END AS biz_code,
         user_id
  FROM events)"""

# raw spans, with the tags as columns
V_SPAN = """v_span AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trace_id, CAST(l_linenumber AS VARCHAR) AS span_id,
         CASE WHEN l_linenumber > 1 THEN CAST(l_linenumber // 2 AS VARCHAR) END AS parent_id,
         CASE l_suppkey % 5 WHEN 0 THEN 'CLIENT' WHEN 1 THEN 'SERVER' WHEN 2 THEN 'PRODUCER'
                            WHEN 3 THEN 'CONSUMER' END AS kind,
         '/' || (l_partkey % 7) AS name,
         TIMESTAMP '2024-02-29 22:30:00' + to_milliseconds(((l_orderkey * 7919) % 10800 + 2 * l_linenumber + l_partkey % 5
           + CASE WHEN l_partkey % 23 = 0 THEN 1200 ELSE 0 END) * 1000 + l_partkey % 1000) AS ts,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS duration,
         'svc' || (l_suppkey % 12) AS local_service,
         CASE WHEN l_partkey % 3 <> 0 THEN 'svc' || (l_partkey % 12) END AS remote_service,
         CASE WHEN l_partkey % 11 = 0 THEN 'select 1' END AS tag_sql,
         CASE WHEN l_linestatus = 'F' AND l_partkey % 13 = 0
              THEN CASE WHEN l_partkey % 2 = 0 THEN '200' ELSE '500' END END AS tag_error,
         CASE WHEN l_partkey % 4 = 0 THEN '/p' || (l_partkey % 5) END AS tag_path,
         CASE WHEN l_suppkey % 3 = 0 THEN 'http' WHEN l_suppkey % 3 = 1 THEN 'grpc' END AS tag_type,
         l_partkey, l_suppkey, l_partkey || '-' || l_suppkey || '-' || CAST(round(l_extendedprice * 100) AS BIGINT)
         || '-' || strftime(l_shipdate, '%Y%m%d') || '-' || l_linestatus AS row_key
  FROM lineitem)"""

# spans with the path override and the derived keys, database spans still present
V_NORM = """v_norm AS (
  SELECT trace_id, span_id, parent_id, kind, coalesce(tag_path, name) AS name, ts, duration,
         local_service, remote_service, tag_sql, tag_error, tag_type, row_key,
         coalesce(remote_service, local_service) AS node_app,
         CASE WHEN parent_id IS NULL THEN coalesce(tag_path, name)
              ELSE coalesce(kind, 'null') || '||' || coalesce(tag_path, name) END AS node_name,
         local_service AS app,
         CASE WHEN parent_id IS NOT NULL THEN coalesce(kind, 'null') END AS metric_kind
  FROM v_span)"""


def with_views(*views: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(views) + "\n"


def v_alarm(table: str, key: str) -> str:
    k = f"CAST({key} AS BIGINT)"
    return f"""v_alarm AS (
  SELECT {k} AS id, 'title-' || ({k} % 50) AS title, CASE WHEN {k} % 4 = 1 THEN 0 WHEN {k} % 4 <> 0 THEN 1 END AS enable,
         60 * ({k} % 5 + 1) AS frequency, 60 * ({k} % 8 + 7) AS throttle, {k} % 4 AS threshold FROM {table})"""


# which rules of v_alarm a kept trace h satisfies
RULE_MATCH = """(CASE r.id % 3 WHEN 0 THEN h.type = 'ERROR' WHEN 1 THEN h.type = 'COST' AND h.duration >= 3000000
  ELSE h.duration >= 1000000 AND h.duration < 5000000 AND h.app = 'svc' || (r.id % 12) END)"""
