"""Trace-tree queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.functions.scale import in_parts, running_count
from tracewell.operators import metrics, trees
from tracewell.plans.registry import query
from tracewell.plans.requests import rounded
from tracewell.plans.spans import METRIC_ROWS, QPS_LIVES, QPS_MAX, interval_metrics, tree_spans
from tracewell.plans.sql_views import V_NORM, V_SPAN, with_views
from tracewell.session import only_kept, stage

FOREST = """nodes AS (
  SELECT trace_id, span_id, parent_id, node_app AS app, node_name AS name, min(ts) AS ts FROM v_norm
  WHERE tag_sql IS NULL AND (parent_id IS NULL OR parent_id <> span_id) GROUP BY ALL),
forest AS (
  SELECT trace_id, span_id AS root_id, app || '==' || name AS root, ts AS root_ts, span_id, parent_id, app, name,
         [span_id] AS path, [app || '==' || name] AS labels, 0 AS depth FROM nodes WHERE parent_id IS NULL
  UNION ALL
  SELECT n.trace_id, f.root_id, f.root, f.root_ts, n.span_id, n.parent_id, n.app, n.name,
         list_append(f.path, n.span_id), list_append(f.labels, n.app || '==' || n.name), f.depth + 1
  FROM forest f JOIN nodes n ON n.trace_id = f.trace_id AND n.parent_id = f.span_id
  WHERE NOT list_contains(f.path, n.span_id))"""

TEMPLATES = FOREST + """,
first_nodes AS (SELECT trace_id, root_id, root, root_ts, app, name, parent_id, arg_min(span_id, (path, labels)) AS span_id
  FROM forest GROUP BY ALL),
template AS (
  SELECT trace_id, root_id, root, root_ts, span_id, parent_id, app, name, [span_id] AS path,
         [app || '==' || name] AS labels, 0 AS depth FROM first_nodes WHERE parent_id IS NULL AND span_id = root_id
         AND app || '==' || name = root
  UNION ALL
  SELECT n.trace_id, n.root_id, n.root, n.root_ts, n.span_id, n.parent_id, n.app, n.name,
         list_append(f.path, n.span_id), list_append(f.labels, n.app || '==' || n.name), f.depth + 1
  FROM template f JOIN first_nodes n ON n.trace_id = f.trace_id AND n.root_id = f.root_id AND n.root = f.root
       AND n.parent_id = f.span_id
  WHERE NOT list_contains(f.path, n.span_id))"""


def _digest(start: int) -> str:
    return f"CAST(sum(CAST('0x' || substr(md5(array_to_string(labels, '>')), {start}, 15) AS BIGINT)) AS VARCHAR)"


SIGNATURES = TEMPLATES + f""",
signed AS (SELECT trace_id, root_id, root, min(root_ts) AS root_ts, count(*) AS size,
           md5(count(*) || ':' || {_digest(1)} || ':' || {_digest(17)}) AS signature
           FROM template GROUP BY trace_id, root_id, root),
chosen AS (SELECT root, signature, count(*) AS trees, max(size) AS size, min((trace_id, root_id)) AS example
           FROM signed GROUP BY root, signature)"""

REPORTED = "2024-03-01 00:15:00"  # the quarter hour that metric trees report
METRIC_TREE = SIGNATURES + ", " + METRIC_ROWS + QPS_MAX + f""",
totals AS (SELECT m.app, CASE WHEN m.metric_kind IS NULL THEN m.name ELSE m.metric_kind || '||' || m.name END AS name,
           total, cost, cost_max, errors, cost_tp95, cost_tp99, error_rate, qps, qps_max FROM v_metric m JOIN qps_fold f
           ON m.w = f.w AND m.app = f.app AND m.name = f.name AND m.metric_kind IS NOT DISTINCT FROM f.metric_kind WHERE m.w = TIMESTAMP '{REPORTED}'),
picked AS (SELECT DISTINCT c.signature, t.root, t.app, t.name, t.labels, t.depth FROM template t JOIN chosen c
           ON t.root = c.root AND t.trace_id = c.example[1] AND t.root_id = c.example[2]),
valued AS (SELECT p.*, total, cost, cost_max, errors, cost_tp95, cost_tp99, error_rate, qps, qps_max FROM picked p LEFT JOIN totals m USING (app, name)),
kept AS (SELECT * FROM valued v WHERE qps IS NOT NULL AND NOT EXISTS (SELECT 1 FROM valued s
         WHERE s.signature = v.signature AND s.qps IS NULL AND s.labels = v.labels[:len(s.labels)])),
mtree AS (SELECT signature, root, CAST('0x' || substr(md5(signature || '|' || array_to_string(labels, '>')), 1, 15)
          AS BIGINT) AS id, CASE WHEN depth = 0 THEN -1 ELSE CAST('0x' || substr(md5(signature || '|' ||
          array_to_string(labels[:len(labels) - 1], '>')), 1, 15) AS BIGINT) END AS pid, app AS app_name, name, depth,
          total, round(cost, 4) AS cost, cost_max, errors, round(cost_tp95, 4) AS cost_tp95,
          round(cost_tp99, 4) AS cost_tp99, round(error_rate, 4) AS error_rate, round(qps, 6) AS qps, round(qps_max, 6) AS qps_max FROM kept)"""


LABELLED = (*trees.TREE, "root_ts", "app", "name", "labels", "depth")   # what signatures and metric trees need of a node


def by_trace(spark: SparkSession, sf: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the tree nodes, a part of the traces at a time."""
    return in_parts(tree_spans(spark, sf), ["trace_id"], lambda spans: work(trees.nodes(spans)))


def span_forest(spark: SparkSession, sf: str) -> DataFrame:
    return by_trace(spark, sf, trees.forest)


def span_templates(spark: SparkSession, sf: str, columns: Sequence[str] = ("*",), root: str | None = None) -> DataFrame:
    def work(nodes: DataFrame) -> DataFrame:
        rows = trees.templates(trees.forest(nodes))
        return (rows if root is None else rows.where(F.col("root") == root)).select(*columns)
    return by_trace(spark, sf, work)


def span_metric_tree(spark: SparkSession, sf: str, root: str | None = None) -> DataFrame:
    """Metric trees of all roots, or of one: the other templates are left out before anything is joined."""
    with only_kept(spark) as kept:
        intervals = stage(interval_metrics(spark, sf), "intervals")
        kept.append(intervals.staged_at)
    rows = span_templates(spark, sf, LABELLED, root)
    chosen = stage(trees.distinct_templates(in_parts(rows, ["trace_id"], trees.signatures)), "chosen")
    every = metrics.with_largest_rate(intervals, ["app", "metric_kind", "name"], "w", QPS_LIVES)
    values = every.where(F.col("w") == F.lit(REPORTED).cast("timestamp")).drop("w")
    out = rounded(trees.metric_tree(rows, chosen, values), "cost", "cost_tp95", "cost_tp99", "error_rate")
    return rounded(out, "qps", "qps_max", places=6)


@query("trace_forest", with_views(V_SPAN, V_NORM, FOREST) + """
SELECT trace_id, root_id, span_id, parent_id, app, name, depth, array_to_string(path, '>') AS path FROM forest""")
def trace_forest(spark, sf):
    return trees.edges(span_forest(spark, sf))


@query("tree_nodes", with_views(V_SPAN, V_NORM, FOREST) + """
SELECT trace_id, root_id, root, app || '==' || name AS node, depth,
       row_number() OVER (PARTITION BY trace_id, root_id, root ORDER BY path, labels) AS pos FROM forest""")
def tree_nodes(spark, sf):
    rows = span_forest(spark, sf).select(*trees.TREE, trees.label().alias("node"), "depth", "path", "labels")
    return running_count(rows, trees.TREE, ["path", "labels"]).drop("path", "labels")


@query("tree_template", with_views(V_SPAN, V_NORM, TEMPLATES) + """
SELECT trace_id, root_id, root, app, name, depth, array_to_string(labels, '>') AS labels FROM template""")
def tree_template(spark, sf):
    return span_templates(spark, sf).select(
        *trees.TREE, "app", "name", "depth", F.array_join("labels", ">").alias("labels"))


@query("tree_signatures", with_views(V_SPAN, V_NORM, SIGNATURES) + """
SELECT root, signature, trees, size, example[1] AS trace_id, example[2] AS root_id FROM chosen""")
def tree_signatures(spark, sf):
    return trees.distinct_templates(trees.signatures(span_templates(spark, sf)))


@query("tree_coverage", with_views(V_SPAN, V_NORM, TEMPLATES) + """
, seen AS (SELECT split_part(root, '==', 1) AS root_app, CAST(root_ts AS DATE) AS day, app || '==' || name AS node,
           min((root_ts, trace_id, root_id, root)) AS tree FROM template GROUP BY ALL)
SELECT root_app, tree[2] AS trace_id, tree[3] AS root_id, tree[4] AS root, tree[1] AS root_ts, count(*) AS new_nodes
FROM seen GROUP BY ALL""")
def tree_coverage(spark, sf):
    return trees.coverage(span_templates(spark, sf))


@query("metric_tree", with_views(V_SPAN, V_NORM, METRIC_TREE) + "SELECT * FROM mtree")
def metric_tree(spark, sf):
    return span_metric_tree(spark, sf)


@query("metric_tree_of", with_views(V_SPAN, V_NORM, METRIC_TREE) + "SELECT * FROM mtree WHERE root = 'svc1==/p1'")
def metric_tree_of(spark, sf):
    return trees.metric_tree_of(span_metric_tree(spark, sf, "svc1==/p1"), "svc1", "/p1")


@query("child_rows", with_views(V_SPAN, V_NORM, METRIC_TREE) + """
SELECT * REPLACE (split_part(name, '||', 2) AS name) FROM mtree WHERE pid > 0""")
def child_rows(spark, sf):
    return trees.child_rows(span_metric_tree(spark, sf))


# no derived tree is deeper than two levels below its root
@query("tree_json", with_views(V_SPAN, V_NORM, METRIC_TREE) + """
, heads AS (SELECT signature, root, id, pid, depth, '{"id":' || id || ',"pid":' || pid || ',"app_name":"' || app_name || '","name":"' || name || '","total":' || total
            || ',"cost_max":' || cost_max || ',"errors":' || errors AS head FROM mtree),
twos AS (SELECT signature, pid, string_agg(head || '}', ',' ORDER BY head || '}') AS below FROM heads WHERE depth = 2 GROUP BY ALL),
ones AS (SELECT h.signature, h.pid, h.head || coalesce(',"children":[' || t.below || ']', '') || '}' AS doc
         FROM heads h LEFT JOIN twos t ON t.signature = h.signature AND t.pid = h.id WHERE depth = 1),
under AS (SELECT signature, pid, string_agg(doc, ',' ORDER BY doc) AS below FROM ones GROUP BY ALL)
SELECT h.signature, h.root, h.head || coalesce(',"children":[' || u.below || ']', '') || '}' AS json
FROM heads h LEFT JOIN under u ON u.signature = h.signature AND u.pid = h.id WHERE depth = 0""")
def tree_json(spark, sf):
    """Nested documents with the whole numbers of each node."""
    return trees.tree_json(span_metric_tree(spark, sf).select(
        "signature", "root", "depth", "id", "pid", "app_name", "name", "total", "cost_max", "errors"))
