"""N-gram Jaccard join by T-occurrence search over inverted lists.

1. A document's set holds its distinct ``SHINGLE``-word sequences as 64-bit hashes; equal sets are one node. Similar sets of n and m elements share at least
   T = ceil(``SIMILAR`` n / 100) of each one's elements, so one of them lies among the n - T + 1 shortest of a set's n inverted lists.
2. All sets rank lists alike. Elements below ``COUNTED`` of the hash range are counted over all sets and ranked by length, shortest first; the others follow by
   their hash. So the lists of shared passages are long ones, and most sets have no short list with a second member: they are done.
3. The short lists' members are searched for candidates star by star, and, where several components are left on a list, pair by pair, block by block
   (``components.bucket_links``); sizes, and for the latter bit sketches of the sets, rule out pairs that cannot reach T.
4. A query's candidates are searched by DivideSkip: of the query's lists over these candidates the L longest are put aside, the others are merged through a heap,
   and only candidates that occur on T - L of them are probed for in the long lists by binary search, until they reach the overlap or cannot any more.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tracewell.llm.components import bucket_links, shared_buckets
from tracewell.llm.shingles import shingle_sets
from tracewell.llm.textbytes import chunks, mix, text_buffer
from tracewell.session import discard, prepare, stage

SHINGLE = 5
SIMILAR = 80      # per cent
COUNTED = 0.25    # share of the hash range whose lists are counted; any share gives the same links
SKIP = 0.01       # the cost factor of DivideSkip's choice of L
SKETCH = 8        # 64-bit words of a sketch
BATCH_SETS = 256
SEARCHED_BYTES = 1 << 20   # of candidates' sets that are searched together
LAST_COUNTED = np.uint64(int(COUNTED * 2 ** 64))


def required(n: int, m: int, similar: int = SIMILAR) -> int:
    """Least intersection of two sets of n and m elements that share ``similar`` per cent of their union."""
    return -(-similar * (n + m) // (100 + similar))


def divide_skip(query: np.ndarray, sets: list[np.ndarray], similar: int = SIMILAR) -> np.ndarray:
    """Indices of the ``sets`` that share ``similar`` per cent of their union with ``query``; all are sorted and hold different values."""
    n = len(query)
    fitting = [i for i, s in enumerate(sets) if n and 100 * min(n, len(s)) >= similar * max(n, len(s))]
    if not fitting:
        return np.zeros(0, dtype=np.int64)
    least = required(n, min(len(sets[i]) for i in fitting), similar)
    values = np.concatenate([sets[i] for i in fitting])
    owner = np.repeat(np.array(fitting), [len(sets[i]) for i in fitting])
    at = np.minimum(np.searchsorted(query, values), n - 1)
    on = query[at] == values
    order = np.lexsort((owner[on], at[on]))
    element, member = at[on][order], owner[on][order]
    lengths = np.bincount(element, minlength=n)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    by_length = np.argsort(lengths, kind="stable")
    long_lists = min(int(least / (SKIP * log2(max(int(lengths.max()), 2)) + 1)), least - 1)
    short = [member[bounds[e]:bounds[e + 1]].tolist() for e in by_length[:n - long_lists].tolist() if lengths[e]]
    aside = [member[bounds[e]:bounds[e + 1]].tolist() for e in by_length[n - long_lists:].tolist() if lengths[e]]
    found = []
    for candidate, places in groupby(heapq.merge(*short)):
        count, need = sum(1 for _ in places), required(n, len(sets[candidate]), similar)
        if count < need - long_lists:
            continue
        left = len(aside)
        for each in reversed(aside):       # the longest first: they hold the candidate most likely
            if count >= need or count + left < need:
                break
            left -= 1
            place = bisect_left(each, candidate)
            count += place < len(each) and each[place] == candidate
        if count >= need:
            found.append(candidate)
    return np.array(found, dtype=np.int64)


def _sets_of(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    data, offsets = text_buffer(column)
    yield from shingle_sets(data, offsets, shingle)


def _digests(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b): size and 128-bit digest of each document's set."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(len(s), mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                    for s in _sets_of(batch.column("text"), shingle)]
            n, a, b = (np.array(c, dtype=np.uint64).view(np.int64) for c in zip(*made)) if made else (np.zeros(0, dtype=np.int64),) * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(a), pa.array(b)], ["doc_id", "n_shingles", "set_a", "set_b"])
    return docs.mapInArrow(rows, "doc_id long, n_shingles long, set_a long, set_b long")


def _lists(docs: DataFrame, shingle: int, similar: int) -> DataFrame:
    """(node, n, spare, mark, elements): the elements of a set that may be on its short lists: the counted ones, and the next ones where these are too few.

    ``spare`` says how many counted elements there are beyond the n - T + 1 short lists; ``mark`` tells sets of one id and size apart.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column("doc_id"), 0
            n, spare, mark, elements = [], [], [], []

            def record() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays(
                    [ids.slice(done, len(n)), pa.array(n, pa.int32()), pa.array(spare, pa.int32()), pa.array(mark, pa.int16()),
                     pa.array(elements, pa.list_(pa.int64()))], ["node", "n", "spare", "mark", "elements"])
            for s in _sets_of(batch.column("text"), shingle):
                counted, short = int(np.searchsorted(s, LAST_COUNTED)), len(s) - -(-similar * len(s) // 100) + 1
                n.append(len(s))
                spare.append(counted - short)
                mark.append(int(mix(s).sum(dtype=np.uint64) >> np.uint64(49)))
                elements.append(s[:max(counted, short)].view(np.int64) if len(s) else s.view(np.int64))
                if len(n) == BATCH_SETS:
                    yield record()
                    done, n, spare, mark, elements = done + len(n), [], [], [], []
            if n:
                yield record()
    return docs.mapInArrow(rows, "node long, n int, spare int, mark short, elements array<long>")


def _short_lists(docs: DataFrame, classes: DataFrame, shingle: int, similar: int) -> DataFrame:
    """(bucket, node, n): members of the short lists, one for each set; a list of one member takes its place among a set's short ones and is left out.

    Lists are counted with all copies of a set, which are left out afterwards.
    """
    rows = _lists(docs, shingle, similar).select(F.explode("elements").alias("bucket"), "node", "n", "spare", "mark")
    lengths = rows.groupBy("bucket").agg(F.count("*").alias("length")).where("length > 1")
    # a set's lists with one member are its shortest; its longest, as many as are to spare, are not searched but probed
    longest = Window.partitionBy("node", "n", "mark").orderBy(F.desc("length"), F.desc("bucket"))
    short = rows.join(lengths, "bucket").withColumn("_place", F.row_number().over(longest)).where("_place > spare")
    return short.select("bucket", "node", F.col("n").cast("long").alias("n")).join(classes.select("node", F.col("n_shingles").alias("n")).distinct(), ["node", "n"], "left_semi")


def _stored_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles, sketch words): full sets; a sketch bit says whether an odd number of values falls on it."""
    words = [f"s{k}" for k in range(SKETCH)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            _, offsets = text_buffer(text)
            for i, j in chunks(offsets):
                sets = list(_sets_of(text.slice(i, j - i), shingle))
                odd = np.array([np.bincount((s & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1 for s in sets], dtype=np.uint8)
                bits = np.packbits(odd, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array([s.tobytes() for s in sets], pa.binary()),
                     *(pa.array(np.ascontiguousarray(c)) for c in bits.T)], ["node", "shingles", *words])
    return docs.mapInArrow(rows, "node long, shingles binary, " + ", ".join(f"{w} long" for w in words))


def _may_reach(similar: int) -> str:
    """Sizes allow the overlap, and the sketches differ in no more bits than the sets then may in values."""
    apart = " + ".join(f"bit_count(n.s{k} ^ m.s{k})" for k in range(SKETCH))
    return (f"100 * least(n.size, m.size) >= {similar} * greatest(n.size, m.size) AND "
            f"({apart}) * (100 + {similar}) <= (100 - {similar}) * (n.size + m.size)")


def _searched(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The links among candidate pairs: ``a``'s candidates, as far as they stand in one batch, are searched together."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in "ab")
            left, right = batch.column("left"), batch.column("right")
            queries, found, start = [], [], 0
            while start < len(a):
                query, end, size = left[start].as_buffer(), start, 0
                while end < len(a) and a[end] == a[start] and size < SEARCHED_BYTES and left[end].as_buffer().equals(query):
                    size += len(right[end].as_buffer())
                    end += 1
                hits = divide_skip(np.frombuffer(query, dtype=np.uint64), [np.frombuffer(right[k].as_buffer(), dtype=np.uint64) for k in range(start, end)], similar)
                queries += [a[start]] * len(hits)
                found += [b[start + k] for k in hits.tolist()]
                start = end
            yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(found, pa.int64())], ["a", "b"])
    # the node that has more candidates is the query: many candidates of a centre are searched at once
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))
    query = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    candidate = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    joined = turned.join(candidate, "b").join(query, "a")
    return joined.select("a", "b", "left", "right").mapInArrow(rows, "a long, b long").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, links.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever their names. Texts of any length are read whole. Words are runs without ASCII white space, A-Z
    lower-cased. A text's set: the distinct ``shingle``-word sequences; with fewer words the whole as one; null, empty and blank texts have an empty set and
    are linked with nothing. Documents whose sets share ``similar`` per cent of their union are linked; component_id is the smallest doc_id reachable, ``links`` the
    number of links found of the document's set with other sets, enough to connect its component. Rows with one id are linked text by text; those with a null id are linked with nothing.
    No rows give no rows.
    """
    prepare(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    digests = stage(_digests(given, shingle), "digests")
    key = ["n_shingles", "set_a", "set_b"]
    classes = stage(digests.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("node")), "classes")
    short = stage(_short_lists(given.where("doc_id IS NOT NULL"), classes, shingle, similar).distinct(), "short-lists")
    members = stage(shared_buckets(short), "members")
    # an id with several texts stands for each of them
    sets = stage(_stored_sets(given.join(members.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi"), shingle), "sets")

    def refine(rest: DataFrame) -> DataFrame:
        words = [f"s{k}" for k in range(SKETCH)]
        return rest.join(sets.select("node", *words), "node").withColumn("n", F.struct(F.col("n").alias("size"), *words))
    links, found = bucket_links(members, lambda pairs: _searched(pairs, sets, similar), f"100 * least(n, m) >= {similar} * greatest(n, m)",
                                refine=refine, refined=_may_reach(similar))
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("links"))
    placed = stage(classes.join(found, "node", "left").join(degree, "node", "left").select(
        *key, F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links")), "placed")
    discard(short, members, sets)
    own = F.col("doc_id").isNotNull()
    return digests.join(placed, key, "left").select(
        "doc_id", "n_shingles", F.when(own, F.coalesce("component", "doc_id")).alias("component_id"),
        F.when(own, F.coalesce("links", F.lit(0))).otherwise(0).alias("links"))
