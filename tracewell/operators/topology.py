"""Call links between services and urls, derived from the spans of each trace.

All joins and groupings use (trace, span) keys, so that one oversized trace still spreads out. The few
per-trace facts (the root) are looked up by a plain join, whose hot keys AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewell.functions import expressions as E
from tracewell.functions.scale import lookup, ordered_slices
from tracewell.operators.metrics import rates
from tracewell.operators.spans import distinct_spans, order_key
from tracewell.session import stage

KEY = ["trace_id", "span_id"]


def prune_orphans(spans: DataFrame) -> DataFrame:
    """Drop spans whose parent is absent, and the direct children of such spans."""
    present = spans.select("trace_id", F.col("span_id").alias("parent_id")).distinct()
    with_parent = spans.where("parent_id is not null")
    orphans = (with_parent.select(*KEY, "parent_id").join(present, ["trace_id", "parent_id"], "left_anti")
               .select(*KEY).distinct())
    below = orphans.withColumnRenamed("span_id", "parent_id")
    kept = (with_parent.join(orphans, KEY, "left_anti")
            .join(below, ["trace_id", "parent_id"], "left_anti").select(*spans.columns))
    return spans.where("parent_id is null").unionByName(kept)


def _node_names(style: str) -> tuple[Column, Column]:
    local, remote = F.col("local_service"), F.col("remote_service")
    if style == "service":
        return local, remote
    return E.topology_node(local, F.col("name")), E.topology_node(remote, F.col("name"))


def merge_shared(spans: DataFrame) -> DataFrame:
    """One node per span id of a trace.

    Of several copies the first server span stands for the node, else the last span with a kind, else
    the last one. Any copy's error marks the node. A missing remote side of the winner is filled from
    the local side of the copy with a kind before it, else the first one after it that has a local side.
    """
    slim = spans.where(F.col("parent_id").isNull() | (F.col("parent_id") != F.col("span_id"))).select(
        *KEY, "parent_id", "kind", "name", "ts", "duration", "local_service", "remote_service",
        E.has_tag(E.TAG_SQL).alias("is_db"), E.tag(E.TAG_TYPE).alias("trace_type"),
        E.has_tag(E.TAG_ERROR).alias("error"), order_key().alias("o"))
    body = F.struct("o", "parent_id", "kind", "name", "ts", "duration", "local_service", "remote_service",
                    "is_db", "trace_type")
    known = F.col("kind").isNotNull()
    served = F.coalesce(F.col("kind") == "SERVER", F.lit(False))
    # a copy is in one of the two bodies only: it is sent once
    merged = stage(slim.groupBy(*KEY).agg(
        F.count("*").alias("copies"), F.max("error").alias("error"), F.min("o").alias("first_o"),
        F.max_by("parent_id", "o").alias("last_parent"),
        F.min(F.when(F.col("parent_id").isNull(), F.col("o"))).alias("rootless_o"),
        F.min_by(F.when(served, body), F.when(served, F.col("o"))).alias("_server"),
        F.max_by(F.when(~served, body), F.when(~served, F.struct(known.alias("known"), "o"))).alias("_other"),
    ).withColumn("w", F.coalesce("_server", "_other")).drop("_server", "_other"), "copies")
    open_remote = (F.col("copies") > 1) & F.col("w.kind").isNotNull() & F.col("w.remote_service").isNull()
    wanting = merged.where(open_remote).select(*KEY, F.col("w.o").alias("w_o"))
    others = (slim.select(*KEY, "kind", "local_service", "o").where(known).join(wanting, KEY)
              .groupBy(*KEY).agg(
                  F.max_by("local_service", F.when(F.col("o") < F.col("w_o"), F.col("o"))).alias("before"),
                  F.min_by("local_service", F.when((F.col("o") > F.col("w_o")) & F.col("local_service").isNotNull(),
                                                   F.col("o"))).alias("after"),
                  F.max(F.col("o") < F.col("w_o")).alias("has_before")))
    filled = merged.join(others, KEY, "left")
    remote = F.coalesce("w.remote_service", F.when(F.col("has_before"), F.col("before")), F.col("after"))
    return filled.select(
        *KEY, "copies", "error", "last_parent", "rootless_o", F.col("first_o.ts").alias("first_ts"),
        F.col("w.parent_id").alias("own_parent"), F.col("w.kind").alias("kind"), F.col("w.name").alias("name"),
        F.col("w.ts").alias("ts"), F.col("w.duration").alias("duration"),
        F.col("w.local_service").alias("local_service"), remote.alias("remote_service"),
        F.col("w.is_db").alias("is_db"), F.col("w.trace_type").alias("trace_type"))


def repair(merged: DataFrame) -> DataFrame:
    """Give every node its effective parent in the repaired tree.

    The earliest span without a parent is the root; further parentless spans and spans whose parent is
    missing hang below it, or below a synthetic root (null) when the trace has none.
    """
    roots = (merged.where("rootless_o is not null and last_parent is null").groupBy("trace_id")
             .agg(F.min_by("span_id", "rootless_o").alias("root_id")))
    rooted = lookup(merged, roots, ["trace_id"])
    present = merged.select("trace_id", F.col("span_id").alias("last_parent"), F.lit(True).alias("_present"))
    linked = rooted.join(present, ["trace_id", "last_parent"], "left")
    return linked.withColumn("is_root", F.coalesce(F.col("span_id") == F.col("root_id"), F.lit(False))).withColumn(
        "parent", F.when(F.col("is_root"), None).when(F.col("_present"), F.col("last_parent"))
        .otherwise(F.col("root_id"))).drop("_present")


def climb(nodes: DataFrame) -> DataFrame:
    """Depth-first facts of every node that reaches the top: path of sibling ranks, nearest kind ancestor.

    Pointer doubling; nodes on cycles never reach the top and are dropped. The paths of a chain of n nodes hold
    n²/2 entries: where only their order and length matter, use ``ascend``.
    """
    kinds = nodes.select("trace_id", F.col("span_id").alias("parent"), F.col("kind").isNotNull().alias("_known"))
    start = nodes.select(*KEY, "parent", "first_ts").join(kinds, ["trace_id", "parent"], "left").select(
        *KEY, F.col("parent").alias("_top"), F.when(F.col("_known"), F.col("parent")).alias("anc"),
        F.array(F.struct(F.col("first_ts").alias("t"), F.col("span_id").alias("i"))).alias("rank"))
    state = stage(start, "climb")
    left = state.where("_top is not null").count()
    while left:
        low, high = state.where("_top is not null").alias("low"), state.alias("high")
        on = (F.col("low.trace_id") == F.col("high.trace_id")) & (F.col("low._top") == F.col("high.span_id"))
        higher = low.join(high, on).select(
            F.col("low.trace_id").alias("trace_id"), F.col("low.span_id").alias("span_id"),
            F.col("high._top").alias("_top"), F.coalesce("low.anc", "high.anc").alias("anc"),
            F.concat("high.rank", "low.rank").alias("rank"))
        state = stage(state.where("_top is null").unionByName(higher), "climb")
        still = state.where("_top is not null").count()
        if still == left:  # only cycles are left: an acyclic node would have come closer to the top
            break
        left = still
    return state.where("_top is null").drop("_top")


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` as a staged table with ``place``: a number that grows in the given order, with gaps.

    A range shuffle and the number of the partition make it, so neither a trace nor the table is sorted in one task.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    return stage(placed.drop(*[c for c in order if c.startswith("_by")]), "places")


def ascend(nodes: DataFrame) -> DataFrame:
    """(trace_id, span_id, anc, depth, place) of every node that reaches the top: what ``climb`` tells, without its paths.

    ``anc`` is the nearest ancestor with a kind (null without one). Within a trace and depth, ``place`` orders nodes as
    their paths of (first_ts, span_id) would. It is kept by rank doubling: the place of twice as long an end of the path is the
    order of (place of its upper half, place of its lower half), so every round handles a few numbers per
    node, whatever the depth. Nodes of one depth arrive at the top in one round, which makes their places comparable. Only rows
    still on their way are written again. Nodes on cycles, or with a null trace or span below the top, never arrive and are dropped.
    """
    kinds = nodes.select("trace_id", F.col("span_id").alias("parent"), F.col("kind").isNotNull().alias("_known"))
    begin = nodes.select(*KEY, "parent", F.col("first_ts").alias("_by_ts")).join(kinds, ["trace_id", "parent"], "left").select(
        *KEY, F.col("parent").alias("_top"), F.when(F.col("_known"), F.col("parent")).alias("anc"), F.lit(1).alias("depth"), "_by_ts")
    latest, arrived = _placed(begin, ["trace_id", "_by_ts", "span_id"]), []
    left = latest.where("_top is not null").count()
    while left:
        reachable = latest
        for part in arrived:
            reachable = reachable.unionByName(part)
        low, high = latest.where("_top is not null").alias("low"), reachable.alias("high")
        on = (F.col("low.trace_id") == F.col("high.trace_id")) & (F.col("low._top") == F.col("high.span_id"))
        higher = low.join(high, on).select(
            F.col("low.trace_id").alias("trace_id"), F.col("low.span_id").alias("span_id"), F.col("high._top").alias("_top"),
            F.coalesce("low.anc", "high.anc").alias("anc"), (F.col("high.depth") + F.col("low.depth")).alias("depth"),
            F.col("high.place").alias("_by_high"), F.col("low.place").alias("_by_low"))
        arrived.append(latest.where("_top is null"))
        latest = _placed(higher, ["trace_id", "_by_high", "_by_low"])
        still = latest.where("_top is not null").count()
        if still == left:  # only cycles are left: an acyclic node would have come closer to the top
            break
        left = still
    result = latest.where("_top is null")
    for part in arrived:
        result = result.unionByName(part)
    return result.drop("_top")


def linked_calls(spans: DataFrame, style: str = "url", prune: bool = True) -> DataFrame:
    """One row per call link: trace, parent, child, error, duration, time and place in the visit order."""
    source = stage(distinct_spans(spans.select(
        *KEY, "parent_id", "kind", "name", "ts", "duration", "local_service", "remote_service", "tags", "row_key")),
        "spans")
    if prune:
        source = stage(prune_orphans(source), "pruned")
    nodes = stage(repair(stage(merge_shared(source), "merged")), "nodes")
    reached = ascend(nodes)
    has_child = nodes.where("parent is not null").select(
        "trace_id", F.col("parent").alias("span_id"), F.lit(True).alias("_has_child")).distinct()
    tags = F.map_filter(F.create_map(
        F.lit(E.TAG_TYPE), F.col("trace_type"), F.lit(E.TAG_SQL), F.when(F.col("is_db"), "")),
        lambda _, v: v.isNotNull())
    local, remote = _node_names(style)
    named = nodes.withColumn("tags", tags).withColumns({"svc": local, "rem": remote})
    anc = named.select("trace_id", F.col("span_id").alias("anc"), F.col("svc").alias("anc_svc"),
                       F.col("kind").alias("anc_kind"), F.col("error").alias("anc_error"))
    full = (named.select(*KEY, "kind", "svc", "rem", "error", "duration", "ts", "own_parent", "is_root")
            .join(reached, KEY).join(has_child, KEY, "left").join(anc, ["trace_id", "anc"], "left"))
    kind = F.coalesce("kind", F.when(F.col("svc").isNotNull() & F.col("rem").isNotNull(), "CLIENT"))
    deferred = (F.col("kind") == "CLIENT") & F.coalesce("_has_child", F.lit(False))
    callee = F.col("k").isin("SERVER", "CONSUMER")
    rows = (full.where(~F.coalesce(deferred, F.lit(False))).withColumn("k", kind).where("k is not null")
            .withColumn("from_node", F.when(callee, F.col("rem")).otherwise(F.col("svc")))
            .withColumn("to_node", F.when(callee, F.col("svc")).otherwise(F.col("rem")))
            .where(~(callee & F.col("is_root") & F.col("from_node").isNull())))
    messaging = F.col("k").isin("PRODUCER", "CONSUMER")
    climbs = ~messaging & F.col("anc_svc").isNotNull()
    backfill = climbs & (F.col("k") == "CLIENT") & F.col("svc").isNotNull() & (F.col("anc_svc") != F.col("svc"))
    source_node = F.coalesce("from_node", F.when(climbs, F.col("anc_svc")))
    from_client = climbs & (F.col("anc_kind") == "CLIENT") & (F.col("own_parent") == F.col("anc"))
    failed = F.col("error") | F.coalesce(from_client & F.col("anc_error"), F.lit(False))

    def link(when: Column, seq: int, parent: Column, child: Column, error: Column) -> Column:
        return F.when(when, F.struct(
            F.lit(seq).alias("seq"), F.lower(parent).alias("parent"), F.lower(child).alias("child"),
            error.alias("error")))

    links = F.array_compact(F.array(
        link(backfill, 0, F.col("anc_svc"), F.col("svc"), F.lit(False)),
        link(source_node.isNotNull() & F.col("to_node").isNotNull(), 1, source_node, F.col("to_node"), failed)))
    return rows.select(*KEY, "duration", "ts", "depth", "place", F.inline(links))


def pairwise_mean(rows: DataFrame, keys: list[str], order: list[Column], value: Column,
                  from_zero: bool = False) -> DataFrame:
    """Running ``(mean + x) / 2`` over the ordered values of each key.

    The fold is associative: a run of n values is the pair of n and the sum of x / 2^k, k counting from its newest
    value. Each key is cut into consecutive slices, a pair is made of each, and the pairs are combined, so
    no task sorts a whole key and every value counts.
    """
    names = [f"_o{i}" for i in range(len(order))]
    narrow = rows.select(*keys, *[o.alias(n) for o, n in zip(order, names)], value.cast("double").alias("_x")).where("_x is not null")
    cut = ordered_slices(narrow, keys, names)
    newest = Window.partitionBy(*keys, "_slice").orderBy(*[F.desc(n) for n in names], F.desc("_x"))
    weighed = cut.withColumn("_k", F.row_number().over(newest))
    runs = weighed.groupBy(*keys, "_slice").agg(
        F.count("*").alias("_n"), F.sum(F.col("_x") * F.pow(F.lit(0.5), F.col("_k"))).alias("_s"), F.max_by("_x", "_k").alias("_oldest"))
    later = Window.partitionBy(*keys).orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("_after", F.coalesce(F.sum("_n").over(later), F.lit(0)))
    total = placed.groupBy(*keys).agg(
        F.sum(F.col("_s") * F.pow(F.lit(0.5), F.col("_after"))).alias("cost"), F.sum("_n").alias("_n"),
        F.min_by("_oldest", "_slice").alias("_oldest"))
    # the first value starts the mean: it weighs as much as the empty mean before it and itself
    start = F.lit(0.0) if from_zero else F.col("_oldest") * F.pow(F.lit(0.5), F.col("_n"))
    return total.select(*keys, (F.col("cost") + start).alias("cost"))


def trace_links(calls: DataFrame) -> DataFrame:
    """Links of each trace: calls, errors and pairwise-mean cost in visit order."""
    keys = ["trace_id", "parent", "child"]
    totals = calls.groupBy(*keys).agg(
        F.count("*").alias("call_count"), F.count_if("error").alias("error_count"), F.min("ts").alias("ts"),
        F.avg(F.when(F.col("duration") > 0, F.col("duration"))).alias("cost_true_mean"))
    means = pairwise_mean(calls.where("duration > 0"), keys, [F.col("depth"), F.col("place"), F.col("seq")],
                          F.col("duration"))
    return totals.join(means, keys, "left").withColumn("cost", F.coalesce("cost", F.lit(0.0)))


def merge_links(links: DataFrame) -> DataFrame:
    """Links of all traces merged per parent and child; cost folds from zero in (time, trace) order."""
    keys = ["parent", "child"]
    totals = links.groupBy(*keys).agg(
        F.sum("call_count").alias("call_count"), F.sum("error_count").alias("error_count"))
    means = pairwise_mean(links, keys, [F.col("ts"), F.col("trace_id")], F.col("cost"), from_zero=True)
    return totals.join(means, keys, "left")


def topology_rows(links: DataFrame, minutes: int = 1) -> DataFrame:
    """Topology rows per interval: calls, one-minute rate, errors, error rate and mean link cost."""
    width = minutes * 60
    keys = ["w_start", "parent", "child"]
    binned = links.withColumn("w_start", E.bucket_start(F.col("ts"), width))
    totals = binned.groupBy(*keys).agg(
        F.sum("call_count").alias("count"), F.sum("error_count").alias("errors"),
        F.avg(F.col("cost").cast("long")).alias("cost"))
    moving = rates(binned, keys, "ts", F.col("w_start") + F.expr(f"INTERVAL {width} SECONDS"), (1,),
                   "call_count").select(*keys, F.col("m1_rate").alias("qps"))
    p_app, p_type, p_url, _ = E.node_parts(F.col("parent"))
    c_app, _, c_url, c_typed = E.node_parts(F.col("child"))
    return totals.join(moving, keys).select(
        F.md5(F.concat_ws("\u0001", F.unix_micros("w_start").cast("string"), "parent", "child")).alias("id"), F.col("w_start").alias("create_time"),
        p_app.alias("parent_app"), p_url.alias("parent_url"), c_app.alias("child_app"),
        F.when(c_typed, c_url).otherwise(p_url).alias("child_url"), p_type.alias("type"),
        "count", "qps", "cost", "errors", E.error_rate(F.col("errors"), F.col("count"), 0.0).alias("error_rate"))
