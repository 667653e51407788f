"""Trace trees as path tables, call-tree templates and metrics per tree node.

A tree is a set of rows with the path from its root. Paths are found by pointer doubling: each round
joins every open path to the path of its topmost known ancestor, so a tree of depth ``d`` takes
``log2(d)`` rounds. Joins use (trace, span), which spreads a large trace over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tracewell.functions import expressions as E
from tracewell.session import discard, stage

TREE = ["trace_id", "root_id", "root"]


def label(app: str = "app", name: str = "name") -> Column:
    return F.concat(F.coalesce(app, F.lit("null")), F.lit("=="), F.coalesce(name, F.lit("null")))


def nodes(spans: DataFrame) -> DataFrame:
    """Distinct tree nodes of normalized spans; spans naming themselves as parent are dropped."""
    parent = F.when(F.col("parent_id") != E.ROOT_PARENT, F.col("parent_id"))
    return (spans.select("trace_id", "span_id", parent.alias("parent_id"), F.col("node_app").alias("app"),
                         F.col("node_name").alias("name"), "ts")
            .where(F.col("parent_id").isNull() | (F.col("parent_id") != F.col("span_id")))
            .groupBy("trace_id", "span_id", "parent_id", "app", "name").agg(F.min("ts").alias("ts")))


def forest(tree_nodes: DataFrame, group: Sequence[str] = ("trace_id",)) -> DataFrame:
    """Every node reachable from a root, with its path of ids and of labels, root first.

    Orphans and cycles are never reached and vanish. Spans sharing an id both own the children, so
    such a child appears once per path.
    """
    group = list(group)
    paths = stage(tree_nodes.select(
        *group, "span_id", "parent_id", "app", "name", F.col("parent_id").alias("_top"),
        F.array("span_id").alias("path"), F.array(label()).alias("labels"),
        F.array(F.coalesce("ts", F.lit(0).cast("timestamp"))).alias("times")), "forest")
    rest = [*group, "span_id", "parent_id", "app", "name"]
    while not paths.where("_top is not null").isEmpty():
        low, high = paths.where("_top is not null").alias("low"), paths.alias("high")
        on = [F.col(f"low.{g}") == F.col(f"high.{g}") for g in group] + [F.col("low._top") == F.col("high.span_id")]
        longer = low.join(high, on).where(~F.arrays_overlap("low.path", "high.path")).select(
            *[F.col(f"low.{c}").alias(c) for c in rest], F.col("high._top").alias("_top"),
            *[F.concat(f"high.{c}", f"low.{c}").alias(c) for c in ("path", "labels", "times")])
        shorter, paths = paths, stage(paths.where("_top is null").unionByName(longer), "forest")
        discard(shorter)
    return paths.drop("_top").withColumns({
        "root_id": F.col("path")[0], "root": F.col("labels")[0], "root_ts": F.col("times")[0],
        "depth": F.size("path") - 1}).drop("times")


def edges(trees: DataFrame) -> DataFrame:
    return trees.select("trace_id", "root_id", "span_id", "parent_id", "app", "name", "depth",
                        F.array_join("path", ">").alias("path"))


def templates(trees: DataFrame) -> DataFrame:
    """Trees without repeated calls: of nodes alike in app, name and parent the first is kept.

    What hung below a dropped node goes with it.
    """
    key = [*TREE, "root_ts", "app", "name", "parent_id"]
    first = trees.groupBy(*key).agg(F.min_by("span_id", F.struct("path", "labels")).alias("span_id"))
    own_root = F.col("parent_id").isNull() & (
        (F.col("span_id") != F.col("root_id")) | (label() != F.col("root")))
    kept = first.where(~own_root).withColumnsRenamed({"root": "_root", "root_ts": "ts"})
    group = ["trace_id", "root_id", "_root"]
    rebuilt = forest(kept.withColumn("ts", F.col("ts")), group)
    return rebuilt.drop("root").withColumnRenamed("_root", "root")


def _digits(text: Column, start: int) -> Column:
    return F.conv(F.substring(F.md5(text), start, 15), 16, 10).cast("decimal(38,0)")


def signatures(template_rows: DataFrame) -> DataFrame:
    """One row per tree with a signature that ignores the order of children.

    The signature adds up digests of the label paths, so no tree is collected in one place.
    """
    path = F.array_join("labels", ">")
    return template_rows.groupBy(*TREE).agg(
        F.min("root_ts").alias("root_ts"), F.count("*").alias("size"),
        F.sum(_digits(path, 1)).alias("_a"), F.sum(_digits(path, 17)).alias("_b"),
    ).select(*TREE, "root_ts", "size", F.md5(F.concat_ws(
        ":", F.col("size").cast("string"), F.col("_a").cast("string"), F.col("_b").cast("string"))).alias("signature"))


def distinct_templates(tree_signatures: DataFrame) -> DataFrame:
    """Distinct call trees per root with how often each occurred and one example tree."""
    return tree_signatures.groupBy("root", "signature").agg(
        F.count("*").alias("trees"), F.max("size").alias("size"),
        F.min(F.struct("trace_id", "root_id")).alias("_example")).select(
        "root", "signature", "trees", "size", F.col("_example.trace_id").alias("trace_id"),
        F.col("_example.root_id").alias("root_id"))


def coverage(template_rows: DataFrame) -> DataFrame:
    """Trees that show a node not seen before that day under the same root app, in time order."""
    app = F.substring_index("root", "==", 1)
    seen = template_rows.select(
        app.alias("root_app"), F.to_date("root_ts").alias("day"), label().alias("node"),
        F.struct("root_ts", "trace_id", "root_id", "root").alias("tree"))
    first = seen.groupBy("root_app", "day", "node").agg(F.min("tree").alias("tree"))
    return first.groupBy("root_app", "day", "tree").agg(F.count("*").alias("new_nodes")).select(
        "root_app", F.col("tree.trace_id").alias("trace_id"), F.col("tree.root_id").alias("root_id"),
        F.col("tree.root").alias("root"), F.col("tree.root_ts").alias("root_ts"), "new_nodes")


def path_id(signature: Column, labels: Column) -> Column:
    """A number for a node of a template, derived from its path."""
    text = F.concat(signature, F.lit("|"), F.array_join(labels, ">"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def metric_tree(template_rows: DataFrame, chosen: DataFrame, metrics: DataFrame, meter: str = "qps") -> DataFrame:
    """Metrics of each node of the distinct templates; a node without a rate, one not called in the reported interval, cuts off its subtree.

    ``metrics`` has app, metric_kind, name and values, among them ``meter``. Nodes name the remote service, metrics the local
    one, so nodes of remote calls often find none.
    """
    wanted = chosen.select("trace_id", "root_id", "root", "signature")
    tree = template_rows.join(wanted, TREE).select(
        "signature", "root", "app", "name", "labels", "depth").distinct()
    named = metrics.withColumn("node_name", F.when(F.col("metric_kind").isNull(), F.col("name")).otherwise(
        F.concat("metric_kind", F.lit(E.SEPARATOR), "name"))).drop("name", "metric_kind")
    values = [c for c in named.columns if c not in ("app", "node_name")]
    # read by several branches below: written down, or each would make the whole join again
    rows = stage(tree.join(named.withColumnRenamed("node_name", "name"), ["app", "name"], "left"), "valued")
    silent = rows.where(F.col(meter).isNull()).select("signature", F.col("labels").alias("_prefix")).distinct()
    prefixes = rows.where(F.col(meter).isNotNull()).withColumn("_prefix", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("labels")), lambda i: F.slice("labels", F.lit(1), i))))
    cut = prefixes.join(silent, ["signature", "_prefix"], "left_semi").select("signature", "labels").distinct()
    kept = rows.where(F.col(meter).isNotNull()).join(cut, ["signature", "labels"], "left_anti")
    above = F.slice("labels", F.lit(1), F.size("labels") - 1)
    return kept.select(
        "signature", "root", path_id(F.col("signature"), F.col("labels")).alias("id"),
        F.when(F.col("depth") == 0, F.lit(-1).cast("long")).otherwise(
            path_id(F.col("signature"), above)).alias("pid"),
        F.col("app").alias("app_name"), "name", "depth", *values)


def metric_tree_of(tree: DataFrame, app: str, name: str) -> DataFrame:
    return tree.where(F.col("root") == F.lit(f"{app}=={name}"))


def child_rows(tree: DataFrame) -> DataFrame:
    """Non-root nodes as results of their own, named by their url part."""
    parts = F.split("name", r"\|\|")
    return tree.where("pid > 0").withColumn("name", F.coalesce(F.try_element_at(parts, F.lit(2)), "name"))


def tree_json(tree: DataFrame) -> DataFrame:
    """Each metric tree as nested JSON text (``children``), built from the deepest level upwards.

    A document holds one template, so its size follows the number of distinct endpoints, not of spans.
    """
    payload = [c for c in tree.columns if c not in ("signature", "root", "depth")]
    rows = stage(tree.withColumn("_json", F.to_json(F.struct(*payload))), "tree")
    depth = rows.agg(F.max("depth")).first()[0]
    if depth is None:
        return rows.select("signature", "root", F.col("_json").alias("json"))
    level = rows.where(F.col("depth") == depth)
    for d in range(depth - 1, -1, -1):
        below = level.groupBy("signature", F.col("pid").alias("id")).agg(
            F.array_join(F.array_sort(F.collect_list("_json")), ",").alias("_children"))
        joined = rows.where(F.col("depth") == d).join(below, ["signature", "id"], "left")
        body = F.expr("substring(_json, 1, length(_json) - 1)")
        level = joined.withColumn("_json", F.when(F.col("_children").isNotNull(), F.concat(
            body, F.lit(',"children":['), "_children", F.lit("]}"))).otherwise(F.col("_json"))).drop("_children")
    return level.select("signature", "root", F.col("_json").alias("json"))
