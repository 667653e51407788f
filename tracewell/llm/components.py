"""Links within buckets by star-shaped candidates, and connected components of the links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tracewell.functions.scale import running_count
from tracewell.session import discard, stage

BLOCK = 1024  # nodes of a bucket that are compared with as many others at once
CHEAP = 8     # open pairs for each open member that are compared at once rather than thinned out by another turn


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none of these has one itself."""
    ends = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.lit(None).cast(edges.schema["v"].dataType).alias("v")))
    centre = F.max(F.col("v").isNull())
    return ends.groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"), centre.alias("centre")).where(
        "low != high OR centre AND low IS NOT NULL").isEmpty()


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Connect the neighbours of each node, and itself, to the smallest of them; pairs are (u, v)."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
    moved = pairs.join(least, "u")
    if larger_only:
        return moved.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    kept = moved.where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return kept.unionByName(least.select("u", F.col("low").alias("v")))


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): every node of an edge with the smallest node it is connected to.

    Self-loops, repeated and reversed edges do no harm; null ends are ignored. No edges give no rows. Each round ends in
    a table in the shared folder, and a number of rounds logarithmic in the longest path suffices.
    """
    a, b = F.col(left), F.col(right)
    edges = stage(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, larger_only=True)
        before, edges = edges, stage(_star(large, larger_only=False).where("u > v").distinct(), "edges")
        discard(before)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _candidates(members: DataFrame, may_link: str, turn: int) -> DataFrame:
    """Pairs (a, b) of a bucket's members with its centre, if their components differ and their sizes allow a link.

    The first turn's centre is the smallest node: like nodes share it over many buckets, so a large group gives few different pairs. Later ones
    are drawn by hashes of component and node that do not depend on the bucket, for the same reason.
    """
    drawn = [F.xxhash64("component", F.lit(turn)).alias("rank"), F.xxhash64("node", F.lit(turn)).alias("place")] if turn else []
    centres = members.groupBy("bucket").agg(F.min(F.struct(*drawn, "node", "component", "n")).alias("c"))
    pairs = members.join(centres, "bucket").where("component != c.component").withColumn("m", F.col("c.n")).where(may_link)
    return pairs.select(F.greatest("node", "c.node").alias("a"), F.least("node", "c.node").alias("b")).distinct()


def _open_pairs(members: DataFrame, may_link: str, blocks: DataFrame) -> DataFrame:
    """All pairs (a, b) of nodes that share a bucket, have different components and may be linked.

    ``members`` has a ``block``: a stretch of at most ``BLOCK`` of a bucket's nodes, ordered by component. Each two blocks of a bucket are compared, and
    each with itself, but for those that hold one and the same component.
    """
    x, y = (blocks.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("block", "low", "high")]) for side in "xy")
    both = x.join(y, "bucket").where("block_x <= block_y AND (low_x < high_x OR low_y < high_y OR low_x < low_y)")
    left = both.select("bucket", F.col("block_x").alias("block"), "block_y").join(members, ["bucket", "block"]).select(
        "bucket", F.col("block_y").alias("block"), F.col("block").alias("of"), F.col("node").alias("left"), F.col("n").alias("n"), F.col("component").alias("c"))
    right = members.select("bucket", "block", F.col("node").alias("right"), F.col("n").alias("m"), F.col("component").alias("d"))
    pairs = left.join(right, ["bucket", "block"]).where("c != d AND (of < block OR left < right)").where(may_link)
    return pairs.select(F.greatest("left", "right").alias("a"), F.least("left", "right").alias("b")).distinct()


def _blocked(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` with the block of each, and (bucket, block, low, high): the components at a block's ends."""
    placed = running_count(members, ["bucket"], ["component", "node"])
    blocked = stage(placed.withColumn("block", F.floor((F.col("pos") - 1) / BLOCK)).drop("pos"), "blocks")
    return blocked, blocked.groupBy("bucket", "block").agg(F.min("component").alias("low"), F.max("component").alias("high"))


def _with_component(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.drop("component").join(found, "node", "left").select("bucket", "node", "n", F.coalesce("component", "node").alias("component"))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` after further links: only the components that these join are looked at."""
    ends = links
    for side in "ab":
        known = found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
        ends = ends.join(known, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    joined = components(ends, "ca", "cb").select(F.col("node").alias("component"), F.col("component").alias("into"))
    moved = found.join(joined, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    single = joined.select(F.col("component").alias("node"), F.col("into").alias("component")).join(found, "node", "left_anti")
    return moved.unionByName(single)


def _open_buckets(members: DataFrame) -> tuple[DataFrame, int, int]:
    """Members of the buckets with several components, their number, and that of the pairs of different components within the buckets."""
    sizes = members.groupBy("bucket", "component").agg(F.count("*").alias("k"))
    buckets = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("k").alias("size"), F.sum(F.col("k") * F.col("k")).alias("squares")).where(
        "parts > 1")
    left = stage(members.join(buckets, "bucket"), "buckets")
    total = left.agg(F.count("*").alias("members"), F.sum((F.col("size") - F.col("squares") / F.col("size")) / 2).alias("pairs")).first()
    return left, total["members"], total["pairs"] or 0


def bucket_links(members: DataFrame, confirm: Callable[[DataFrame], DataFrame], may_link: str,
                 refine: Callable[[DataFrame], DataFrame] | None = None, refined: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(links, components) of nodes that share buckets: the components are those of all links within buckets.

    ``members``: bucket, size (its number of nodes), node, n (a node's size); ``may_link`` is a condition on the sizes n and m of two nodes. ``confirm`` keeps of
    (a, b) the pairs that are links. A turn gives at most one candidate for each member of a bucket. Buckets left with
    several components get other centres, as long as that halves the pairs of different components left within buckets: so
    large groups are joined by few links. Then all these pairs are compared, block by block, unless there were none. ``refine`` may replace the n
    of the nodes left by more than their size, for the condition ``refined`` on them.
    """
    current = members.where("size > 1").select("bucket", "node", "n", F.col("node").alias("component"))
    links, found, turn = None, None, 0
    work = members.where("size > 1").agg(F.sum((F.col("size") - 1) / 2).alias("pairs")).first()["pairs"] or 0
    while True:
        pairs = stage(_candidates(current, may_link, turn), "pairs")
        confirmed = stage(confirm(pairs), "links")
        links = confirmed if links is None else links.unionByName(confirmed)
        found = stage(components(confirmed, "a", "b") if found is None else _merged(found, confirmed), "components")
        following, count, open_pairs = _open_buckets(_with_component(current, found))
        discard(pairs, current)
        current = following
        if open_pairs <= CHEAP * count or 2 * open_pairs > work:
            break
        turn, work = turn + 1, open_pairs
    if count:
        rest, condition = current, may_link
        if refine is not None:
            rest, condition = refine(current), refined
        blocked, blocks = _blocked(rest.select("bucket", "node", "n", "component"))
        pairs = stage(_open_pairs(blocked, condition, blocks), "pairs")
        confirmed = stage(confirm(pairs), "links")
        links, found = links.unionByName(confirmed), stage(_merged(found, confirmed), "components")
        discard(pairs, current, blocked)
    return links.distinct(), found


def shared_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, size, node, n) of the buckets with two nodes or more."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "bucket").select("bucket", "size", "node", "n")
