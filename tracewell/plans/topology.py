"""Call-topology queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tracewell.functions.scale import in_parts
from tracewell.operators import topology
from tracewell.plans.registry import query
from tracewell.plans.requests import rate_sql, rounded
from tracewell.plans.spans import normalized
from tracewell.plans.sql_views import V_NORM, V_SPAN, with_views
from tracewell.session import stage
from tracewell.streaming import windows

PRUNED = """sp AS (SELECT *, (ts, span_id, coalesce(kind, ''), row_key) AS o FROM v_norm),
ids AS (SELECT DISTINCT trace_id, span_id FROM sp),
orph AS (SELECT DISTINCT trace_id, span_id FROM sp s WHERE parent_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM ids i WHERE i.trace_id = s.trace_id AND i.span_id = s.parent_id)),
pruned AS (SELECT * FROM sp s WHERE parent_id IS NULL OR NOT EXISTS (
  SELECT 1 FROM orph x WHERE x.trace_id = s.trace_id AND (x.span_id = s.span_id OR x.span_id = s.parent_id)))"""

# copies of a span id folded one after the other
MERGED = PRUNED + """,
cp AS (SELECT *, row_number() OVER (PARTITION BY trace_id, span_id ORDER BY o) AS rn FROM pruned
       WHERE parent_id IS NULL OR parent_id <> span_id),
fold AS (
  SELECT trace_id, span_id, rn, ts AS first_ts, parent_id AS last_parent, parent_id AS own_parent, kind, name, ts,
         duration, local_service, remote_service, tag_sql, tag_type, tag_error IS NOT NULL AS error
  FROM cp WHERE rn = 1
  UNION ALL
  SELECT f.trace_id, f.span_id, c.rn, f.first_ts, c.parent_id,
         CASE WHEN r THEN c.parent_id ELSE f.own_parent END, CASE WHEN r THEN c.kind ELSE f.kind END,
         CASE WHEN r THEN c.name ELSE f.name END, CASE WHEN r THEN c.ts ELSE f.ts END,
         CASE WHEN r THEN c.duration ELSE f.duration END,
         CASE WHEN r THEN c.local_service ELSE f.local_service END,
         CASE WHEN f.kind IS NULL OR c.kind IS NULL THEN CASE WHEN r THEN c.remote_service ELSE f.remote_service END
              WHEN r THEN coalesce(c.remote_service, f.local_service)
              ELSE coalesce(f.remote_service, c.local_service) END,
         CASE WHEN r THEN c.tag_sql ELSE f.tag_sql END, CASE WHEN r THEN c.tag_type ELSE f.tag_type END,
         f.error OR c.tag_error IS NOT NULL
  FROM fold f JOIN (SELECT *, true AS one FROM cp) c
    ON c.trace_id = f.trace_id AND c.span_id = f.span_id AND c.rn = f.rn + 1,
    LATERAL (SELECT f.kind IS NULL OR (c.kind IS NOT NULL AND f.kind <> 'SERVER') AS r)),
merged AS (SELECT * FROM fold QUALIFY rn = max(rn) OVER (PARTITION BY trace_id, span_id))"""

REPAIRED = MERGED + """,
rootless AS (SELECT c.trace_id, c.span_id, min(c.o) AS ro FROM cp c JOIN merged m USING (trace_id, span_id)
             WHERE c.parent_id IS NULL AND m.last_parent IS NULL GROUP BY ALL),
roots AS (SELECT trace_id, arg_min(span_id, ro) AS root_id FROM rootless GROUP BY trace_id),
tree AS (SELECT m.*, r.root_id, coalesce(m.span_id = r.root_id, false) AS is_root,
         CASE WHEN m.span_id = r.root_id THEN NULL WHEN p.span_id IS NOT NULL THEN m.last_parent ELSE r.root_id END AS parent
         FROM merged m LEFT JOIN roots r USING (trace_id)
         LEFT JOIN merged p ON p.trace_id = m.trace_id AND p.span_id = m.last_parent)"""

CALLS = REPAIRED + """,
walk AS (
  SELECT t.*, [strftime(first_ts, '%Y%m%d%H%M%S%f') || '#' || span_id] AS rank, CAST(NULL AS VARCHAR) AS anc
  FROM tree t WHERE parent IS NULL
  UNION ALL
  SELECT t.*, list_append(w.rank, strftime(t.first_ts, '%Y%m%d%H%M%S%f') || '#' || t.span_id),
         CASE WHEN w.kind IS NOT NULL THEN w.span_id ELSE w.anc END
  FROM walk w JOIN tree t ON t.trace_id = w.trace_id AND t.parent = w.span_id),
named AS (SELECT *, {local} AS svc, {remote} AS rem FROM walk),
full_rows AS (
  SELECT n.*, a.svc AS anc_svc, a.kind AS anc_kind, a.error AS anc_error,
         coalesce(n.kind, CASE WHEN n.svc IS NOT NULL AND n.rem IS NOT NULL THEN 'CLIENT' END) AS k
  FROM named n LEFT JOIN named a ON a.trace_id = n.trace_id AND a.span_id = n.anc
  WHERE NOT (coalesce(n.kind = 'CLIENT', false) AND EXISTS (
    SELECT 1 FROM tree c WHERE c.trace_id = n.trace_id AND c.parent = n.span_id))),
sided AS (SELECT *, CASE WHEN k IN ('SERVER', 'CONSUMER') THEN rem ELSE svc END AS p,
          CASE WHEN k IN ('SERVER', 'CONSUMER') THEN svc ELSE rem END AS c,
          k NOT IN ('PRODUCER', 'CONSUMER') AND anc_svc IS NOT NULL AS climbs FROM full_rows WHERE k IS NOT NULL),
calls AS (
  SELECT trace_id, span_id, duration, ts, rank, 0 AS seq, lower(anc_svc) AS parent, lower(svc) AS child, false AS error
  FROM sided WHERE climbs AND k = 'CLIENT' AND svc IS NOT NULL AND anc_svc <> svc
  UNION ALL
  SELECT trace_id, span_id, duration, ts, rank, 1, lower(CASE WHEN p IS NULL AND climbs THEN anc_svc ELSE p END), lower(c),
         error OR coalesce(climbs AND anc_kind = 'CLIENT' AND own_parent = anc AND anc_error, false)
  FROM sided WHERE NOT (is_root AND k IN ('SERVER', 'CONSUMER') AND p IS NULL)
    AND c IS NOT NULL AND (p IS NOT NULL OR climbs))"""


def _node(service: str) -> str:
    return (f"{service} || '|' || coalesce(tag_type, 'null') || ':' || "
            "CASE WHEN tag_sql IS NULL THEN name ELSE 'DB-READ' END")


URL_CALLS = CALLS.format(local=_node("local_service"), remote=_node("remote_service"))
SERVICE_CALLS = CALLS.format(local="local_service", remote="remote_service")

LINKS = """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY trace_id, parent, child ORDER BY len(rank) DESC, rank DESC, seq DESC)
           AS kk, count(*) OVER (PARTITION BY trace_id, parent, child) AS size FROM calls WHERE duration > 0),
means AS (SELECT trace_id, parent, child,
          sum(duration * pow(0.5, CASE WHEN kk = size THEN kk - 1 ELSE kk END)) AS cost FROM ranked GROUP BY ALL),
links AS (SELECT c.trace_id, c.parent, c.child, count(*) AS call_count, count(*) FILTER (c.error) AS error_count,
          min(c.ts) AS ts, coalesce(any_value(m.cost), 0) AS cost
          FROM calls c LEFT JOIN means m USING (trace_id, parent, child) GROUP BY ALL)"""


def _views(*parts: str) -> str:
    return with_views(V_SPAN, V_NORM, *parts)


def by_trace(spark: SparkSession, sf: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the spans, a part of the traces at a time: traces do not know of each other."""
    return in_parts(normalized(spark, sf), ["trace_id"], work)


def calls(spark: SparkSession, sf: str, style: str = "url", columns: Sequence[str | Column] = ("*",)) -> DataFrame:
    return by_trace(spark, sf, lambda spans: topology.linked_calls(spans, style).select(*columns))


def links(spark: SparkSession, sf: str) -> DataFrame:
    return by_trace(spark, sf, lambda spans: topology.trace_links(topology.linked_calls(spans)))


def pruned(spans: DataFrame) -> DataFrame:
    return topology.prune_orphans(stage(spans))


@query("prune_orphans", _views(PRUNED) + "SELECT trace_id, span_id, parent_id, row_key FROM pruned")
def prune_orphans(spark, sf):
    return by_trace(spark, sf, lambda spans: pruned(spans).select("trace_id", "span_id", "parent_id", "row_key"))


@query("merge_shared", _views(MERGED) + """
SELECT trace_id, span_id, rn AS copies, last_parent, own_parent, kind, name, ts, duration, local_service, remote_service,
CAST(error AS INT) AS error FROM merged""")
def merge_shared(spark, sf):
    return by_trace(spark, sf, lambda spans: topology.merge_shared(stage(pruned(spans))).select(
        "trace_id", "span_id", "copies", "last_parent", "own_parent", "kind", "name", "ts", "duration", "local_service",
        "remote_service", F.col("error").cast("int").alias("error")))


def repaired(spans: DataFrame) -> DataFrame:
    return topology.repair(stage(topology.merge_shared(stage(pruned(spans)))))


@query("repair_tree", _views(REPAIRED) + "SELECT trace_id, span_id, root_id, parent, CAST(is_root AS INT) AS is_root FROM tree")
def repair_tree(spark, sf):
    return by_trace(spark, sf, lambda spans: repaired(spans).select(
        "trace_id", "span_id", "root_id", "parent", F.col("is_root").cast("int").alias("is_root")))


@query("rpc_ancestor", _views(URL_CALLS) + "SELECT trace_id, span_id, anc, len(rank) AS depth FROM walk")
def rpc_ancestor(spark, sf):
    return by_trace(spark, sf, lambda spans: topology.ascend(stage(repaired(spans))).select("trace_id", "span_id", "anc", "depth"))


@query("topo_calls", _views(URL_CALLS) + """
SELECT trace_id, span_id, seq, parent, child, CAST(error AS INT) AS error, duration, ts FROM calls""")
def topo_calls(spark, sf):
    return calls(spark, sf, columns=("trace_id", "span_id", "seq", "parent", "child",
                                     F.col("error").cast("int").alias("error"), "duration", "ts"))


@query("topo_links", _views(URL_CALLS + LINKS) + """
SELECT trace_id, parent, child, call_count, error_count, round(cost, 4) AS cost FROM links""")
def topo_links(spark, sf):
    return rounded(links(spark, sf).select("trace_id", "parent", "child", "call_count", "error_count", "cost"), "cost")


@query("topo_merge", _views(URL_CALLS + LINKS) + """
, r AS (SELECT *, row_number() OVER (PARTITION BY parent, child ORDER BY ts DESC, trace_id DESC) AS kk FROM links)
SELECT parent, child, CAST(sum(call_count) AS BIGINT) AS call_count, CAST(sum(error_count) AS BIGINT) AS error_count,
       round(sum(cost * pow(0.5, kk)), 4) AS cost FROM r GROUP BY ALL""")
def topo_merge(spark, sf):
    return rounded(topology.merge_links(links(spark, sf)), "cost")


@query("topo_rows", _views(URL_CALLS + LINKS, "binned AS (SELECT *, date_trunc('minute', ts) AS w_start FROM links)",
       rate_sql("binned", "w_start, parent, child", "w_start + INTERVAL 1 MINUTE", (1,), weight="call_count")) + """
, parts AS (SELECT *, string_split(parent, '|') AS pp, string_split(child, '|') AS cc FROM binned)
SELECT w_start AS create_time, pp[1] AS parent_app, string_split(pp[2], ':')[2] AS parent_url, cc[1] AS child_app,
       string_split(cc[2], ':')[2] AS child_url, string_split(pp[2], ':')[1] AS type,
       CAST(sum(call_count) AS BIGINT) AS count, round(any_value(m1_rate), 6) AS qps,
       round(avg(CAST(floor(cost) AS BIGINT)), 4) AS cost, CAST(sum(error_count) AS BIGINT) AS errors,
       round(sum(error_count) * 100.0 / sum(call_count), 4) AS error_rate
FROM parts JOIN rated USING (w_start, parent, child) GROUP BY ALL""")
def topo_rows(spark, sf):
    rows = topology.topology_rows(links(spark, sf)).drop("id")
    return rounded(rounded(rows, "cost", "error_rate"), "qps", places=6)


@query("service_links", _views(SERVICE_CALLS) + """
SELECT parent, child, count(*) AS call_count, count(*) FILTER (error) AS error_count FROM calls GROUP BY ALL""")
def service_links(spark, sf):
    return calls(spark, sf, "service", ("parent", "child", "error")).groupBy("parent", "child").agg(
        F.count("*").alias("call_count"), F.count_if("error").alias("error_count"))


@query("win_links", _views(URL_CALLS) + """
SELECT w AS w_start, parent || '|' || child AS link, count(*) AS n
FROM calls, LATERAL (SELECT unnest(generate_series(0, 2)) AS i),
     LATERAL (SELECT to_timestamp(epoch_us(ts) // 300000000 * 300 - i * 300)::TIMESTAMP AS w) GROUP BY ALL""")
def win_links(spark, sf):
    """Call links counted in 15-minute windows sliding by five minutes."""
    counted = windows.windowed_counts(calls(spark, sf, columns=("ts", "parent", "child")), "ts", F.concat_ws("|", "parent", "child"), "15 minutes", "5 minutes")
    return counted.select("w_start", F.col("key").alias("link"), "n")
