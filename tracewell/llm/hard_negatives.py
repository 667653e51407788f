"""Hard negatives by exact search: Hilbert-ordered candidate blocks with zone maps, read only where an anchor's windows may be met.

1. Vectors of integers are ordered along a Hilbert curve through all their dimensions and written as Parquet rows of ``BLOCK`` vectors each, with the
   least and greatest value of each dimension (the zone map) and of the labels.
2. From an anchor and a zone map, interval arithmetic gives bounds of all inner products with the block's vectors. The zone maps, read alone, are
   compared with batches of anchors, page by page; a block is read by the anchors whose bounds it may meet, and by no others.
3. Positives: the anchor's own block gives a least score that its best positives reach; other blocks must be able to reach it.
4. Negatives: each positive's score gives a window of scores; the own block again tightens it. Blocks whose bounds meet a window are read.

Anchors grow with the rows, so work is the product of both, in blocks; each pair of block and batch is one row with as many bytes as these have, and what a block gives
an anchor is cut to the number wanted. Nothing depends on how many rows share a label or a vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewell.llm.vectors import SCALE, matrix, same_width, whole_rows
from tracewell.session import discard, prepare, stage

BLOCK = 2048        # vectors of a block
ANCHORS = 256       # anchors of a batch
PAGE = 256          # zone maps compared with a batch at once
CURVE_BITS = 4      # steps along each dimension, as a power of two
NO_SCORE = -(1 << 62)


def hilbert_keys(steps: np.ndarray, bits: int) -> list[bytes]:
    """Place of each point along the Hilbert curve through all dimensions; ``steps`` are whole numbers below 2^bits, points x dimensions.

    The coordinates are turned into the transposed index plane by plane (from the highest bit: undo the turns and reflections of the cell that
    the point lies in), then Gray-decoded; the bits of a plane, one for each dimension, follow each other in the key.
    """
    x = steps.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        high, low = 1 << b, (1 << b) - 1
        for d in range(dims):
            turned = (x[d] & high) != 0
            swap = np.where(turned, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1, (1 << b) - 1, 0)
    x ^= flip
    planes = np.concatenate([((x >> b) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1)])
    return [row.tobytes() for row in np.packbits(planes.T, axis=1)]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where these stay whole numbers it can hold."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def score_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product that any vector between ``low`` and ``high`` may have with each anchor; anchors x zone maps."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return _scores(up, low) + _scores(down, high), _scores(up, high) + _scores(down, low)


def _best(hit: np.ndarray, scores: np.ndarray, ids: np.ndarray, places: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the first ``most`` hits of each row: higher scores first, then smaller ids, then places."""
    row, column = np.nonzero(hit)
    order = np.lexsort((places[column], ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    begin = np.searchsorted(row, np.arange(len(hit)))
    kept = np.arange(len(row)) - begin[row] < most
    return row[kept], column[kept]


def _packed(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


BLOCK_FIELDS = "block long, n int, ids binary, labels binary, anchors binary, vectors binary, low binary, high binary, label_low long, label_high long"


def write_blocks(rows: DataFrame, width: int, kind: str) -> DataFrame:
    """Blocks of vectors in the order of the curve; ``rows``: vec_id, label, anchor, embedding; ``kind`` is the type of a stored component."""
    reach = rows.agg(F.min(F.array_min("embedding")).alias("low"), F.max(F.array_max("embedding")).alias("high")).first()
    low, high = (0, 0) if reach["low"] is None else (int(np.floor(SCALE * reach[k])) for k in ("low", "high"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("embedding"), width)
            steps = (values - low) * (1 << CURVE_BITS) // (high - low + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("anchor"), pa.array(hilbert_keys(steps, CURVE_BITS), pa.binary()),
                 pa.array([_packed(v) for v in values.astype(kind)], pa.binary())], ["vec_id", "label", "anchor", "curve", "vector"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        kept: list[pa.RecordBatch] = []

        def record(part: pa.Table) -> pa.RecordBatch:
            nonlocal number
            ids, labels, anchor = (part.column(c).to_numpy() for c in ("vec_id", "label", "anchor"))
            values = np.frombuffer(b"".join(part.column("vector").to_pylist()), dtype=kind).reshape(-1, width)
            made = [number, len(ids), _packed(ids), _packed(labels), _packed(np.flatnonzero(anchor)), _packed(values), _packed(values.min(axis=0)),
                    _packed(values.max(axis=0)), int(labels.min()), int(labels.max())]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(made, BLOCK_TYPE)], schema=BLOCK_TYPE)
        for batch in batches:
            kept.append(batch)
            if sum(b.num_rows for b in kept) >= BLOCK:
                table = pa.Table.from_batches(kept)
                for a in range(0, table.num_rows - BLOCK + 1, BLOCK):
                    yield record(table.slice(a, BLOCK))
                kept = table.slice(table.num_rows - table.num_rows % BLOCK).combine_chunks().to_batches() if table.num_rows % BLOCK else []
        if kept and sum(b.num_rows for b in kept):
            yield record(pa.Table.from_batches(kept))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    along = rows.select("vec_id", "label", "anchor", "embedding").mapInArrow(keyed, "vec_id long, label long, anchor boolean, curve binary, vector binary")
    ordered = along.repartitionByRange(parts, "curve", "vec_id").sortWithinPartitions("curve", "vec_id")
    return stage(ordered.mapInArrow(blocks, BLOCK_FIELDS), "blocks")


BLOCK_TYPE = pa.schema([("block", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "anchors", "vectors", "low", "high")),
                        ("label_low", pa.int64()), ("label_high", pa.int64())])


def _own_positives(blocks: DataFrame, width: int, kind: str, most: int) -> DataFrame:
    """(anchor, anchor_id, label, vector, floor): every anchor, and the score of its last wanted positive within its own block."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, labels, at, values in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "labels", "anchors", "vectors"))):
                ids, labels, at = (np.frombuffer(x, dtype=np.int64) for x in (ids, labels, at))
                values = np.frombuffer(values, dtype=kind).reshape(-1, width)
                scores = _scores(values[at], values)
                scores[(labels[at, None] != labels) | (at[:, None] == np.arange(len(ids)))] = NO_SCORE
                floor = np.sort(scores, axis=1)[:, -most] if len(ids) >= most and len(at) else np.full(len(at), NO_SCORE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block * BLOCK + at), pa.array(ids[at]), pa.array(labels[at]), pa.array([_packed(v) for v in values[at]], pa.binary()),
                     pa.array(floor)], ["anchor", "anchor_id", "label", "vector", "floor"])
    return blocks.select("block", "ids", "labels", "anchors", "vectors").mapInArrow(
        rows, "anchor long, anchor_id long, label long, vector binary, floor long")


def _batches(anchors: DataFrame, windows: int) -> DataFrame:
    """Anchors packed by ``ANCHORS``: batch, anchors, labels, vectors, lows, highs (``windows`` bounds of scores for each anchor)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a in range(0, batch.num_rows, ANCHORS):
                part = batch.slice(a, ANCHORS)
                lows, highs = (np.array(part.column(c).to_pylist(), dtype=np.int64).reshape(-1, windows) for c in ("lows", "highs"))
                made = [number, *(_packed(part.column(c).to_numpy()) for c in ("anchor", "label")), b"".join(part.column("vector").to_pylist()), _packed(lows), _packed(highs)]
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in made], ["batch", "anchors", "labels", "vectors", "lows", "highs"])
    few = max(1, anchors.count() // (16 * ANCHORS))
    return anchors.select("anchor", "label", "vector", "lows", "highs").coalesce(few).mapInArrow(
        rows, "batch long, anchors binary, labels binary, vectors binary, lows binary, highs binary")


def _chosen(batches: DataFrame, blocks: DataFrame, width: int, kind: str, windows: int, same_label: bool) -> DataFrame:
    """(block, anchors, labels, vectors, lows, highs): the anchors of a batch that must read a block.

    Every batch meets every page of zone maps once; of the blocks only the zone maps are read here.
    """
    zones = blocks.select("block", "low", "high", "label_low", "label_high")
    pages = max(1, -(-zones.count() // PAGE))
    grouped = zones.groupBy(F.pmod(F.xxhash64("block"), F.lit(pages)).alias("page")).agg(F.collect_list(F.struct("*")).alias("zones"))
    met = batches.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long")))).join(grouped, "page")

    def rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ["anchors", "labels", "vectors", "lows", "highs"]
        for batch in found:
            for i in range(batch.num_rows):
                anchors, labels, lows, highs = (np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int64) for c in ("anchors", "labels", "lows", "highs"))
                vectors = np.frombuffer(batch.column("vectors")[i].as_py(), dtype=kind).reshape(-1, width)
                lows, highs = lows.reshape(-1, windows), highs.reshape(-1, windows)
                zones = batch.column("zones")[i].as_py()
                low, high = (np.frombuffer(b"".join(z[c] for z in zones), dtype=kind).reshape(-1, width) for c in ("low", "high"))
                label_low, label_high = (np.array([z[c] for z in zones], dtype=np.int64) for c in ("label_low", "label_high"))
                least, greatest = score_bounds(vectors, low, high)
                wanted = np.zeros(least.shape, dtype=bool)
                for w in range(windows):
                    wanted |= (greatest >= lows[:, w, None]) & (least <= highs[:, w, None])
                if same_label:
                    wanted &= (label_low <= labels[:, None]) & (labels[:, None] <= label_high)
                else:
                    wanted &= (label_low != labels[:, None]) | (labels[:, None] != label_high)
                read = np.flatnonzero(wanted.any(axis=0))
                for a in range(0, len(read), 32):
                    made = [(zones[z]["block"], *(_packed(x[wanted[:, z]]) for x in (anchors, labels, vectors, lows, highs))) for z in read[a:a + 32].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*made)], ["block", *fields])
    return met.select("zones", "anchors", "labels", "vectors", "lows", "highs").mapInArrow(
        rows, "block long, anchors binary, labels binary, vectors binary, lows binary, highs binary")


def _read(chosen: DataFrame, blocks: DataFrame, width: int, kind: str, windows: int, same_label: bool, most: int) -> DataFrame:
    """(anchor, window, score, other, other_id): of each block and window of an anchor the first ``most`` rows of its label, or of another one."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                take = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                anchors, labels, lows, highs, ids, others = (np.frombuffer(take[c], dtype=np.int64) for c in (
                    "anchors", "labels", "lows", "highs", "ids", "block_labels"))
                vectors, values = (np.frombuffer(take[c], dtype=kind).reshape(-1, width) for c in ("vectors", "block_vectors"))
                lows, highs = lows.reshape(-1, windows), highs.reshape(-1, windows)
                places = take["block"] * BLOCK + np.arange(len(ids))
                scores = _scores(vectors, values)
                fits = (labels[:, None] == others) & (anchors[:, None] != places) if same_label else labels[:, None] != others
                for w in range(windows):
                    row, column = _best(fits & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None]), scores, ids, places, most)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors[row]), pa.array(np.full(len(row), w, dtype=np.int32)), pa.array(scores[row, column]), pa.array(places[column]),
                         pa.array(ids[column])], ["anchor", "window", "score", "other", "other_id"])
    stored = blocks.select("block", "ids", F.col("labels").alias("block_labels"), F.col("vectors").alias("block_vectors"))
    return chosen.join(stored, "block").mapInArrow(rows, "anchor long, window int, score long, other long, other_id long")


def _first(found: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id", "other")
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def _own_negatives(blocks: DataFrame, windowed: DataFrame, width: int, kind: str, windows: int, most: int) -> DataFrame:
    """(anchor, lows): the windows' lower ends, raised to the score of the last wanted negative within the own block if it has that many."""
    per_block = windowed.groupBy(F.floor(F.col("anchor") / BLOCK).alias("block")).agg(F.collect_list(F.struct("anchor", "lows", "highs")).alias("wanted"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wanted, labels, values in zip(*(batch.column(c).to_pylist() for c in ("wanted", "labels", "vectors"))):
                labels, values = np.frombuffer(labels, dtype=np.int64), np.frombuffer(values, dtype=kind).reshape(-1, width)
                anchors = np.array([x["anchor"] for x in wanted], dtype=np.int64)
                lows, highs = (np.array([x[c] for x in wanted], dtype=np.int64).reshape(-1, windows) for c in ("lows", "highs"))
                at = anchors % BLOCK
                scores = _scores(values[at], values)
                raised = lows.copy()
                for w in range(windows if len(labels) >= most else 0):
                    hit = (labels[at, None] != labels) & (scores >= lows[:, w, None]) & (scores <= highs[:, w, None])
                    last = np.sort(np.where(hit, scores, NO_SCORE), axis=1)[:, -most]
                    raised[:, w] = np.maximum(lows[:, w], last)
                yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(list(raised), pa.list_(pa.int64()))], ["anchor", "lows"])
    joined = per_block.join(blocks.select("block", "labels", "vectors"), "block")
    return joined.select("wanted", "labels", "vectors").mapInArrow(rows, "anchor long, lows array<long>")


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), exact.

    ``vectors`` needs ``vec_id``, ``label`` (a whole number) and ``embedding``; ``is_anchor`` is a condition on them. Rows with a null id or label, a null or empty vector, a
    null or non-finite component, or a vector of another length than that of the smallest id take no part. Scores are inner products of
    floor(256 x). An anchor's positives are its first ``positives`` other rows of the same label; for each of them come the first ``negatives`` rows of other
    labels with ``low`` * positive score <= 100 * negative score <= ``high`` * positive score. Higher scores come first, then smaller ids. Repeated rows and ids are rows of their own.
    An anchor without another row of its label, or without a fitting negative, gives no rows.
    """
    prepare(vectors.sparkSession)
    given = whole_rows(vectors).withColumn("label", F.col("label").cast("long")).where("vec_id IS NOT NULL AND label IS NOT NULL")
    given, width = same_width(given.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))))
    reach = given.agg(F.max(F.greatest(F.abs(F.array_min("embedding")), F.abs(F.array_max("embedding")))).alias("r")).first()["r"] or 0.0
    kind = "<i2" if SCALE * reach < (1 << 15) - 1 else "<i4"
    blocks = write_blocks(given, width, kind)
    anchors = stage(_own_positives(blocks, width, kind, positives), "anchors")
    open_ended = anchors.withColumn("lows", F.array("floor")).withColumn("highs", F.array(F.lit(-NO_SCORE)))
    chosen = _chosen(_batches(open_ended, 1), blocks, width, kind, 1, True)
    found = _read(chosen, blocks, width, kind, 1, True, positives)
    best = stage(_first(found, ["anchor"], positives, "place").select("anchor", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # an anchor with fewer positives has empty windows for the rest
    scores = [F.max(F.when(F.col("place") == k + 1, F.col("positive_score"))) for k in range(positives)]
    hundred = F.lit(100).cast("long")

    def whole_part(x: Column) -> Column:
        """floor(x / 100), exactly."""
        return ((x - F.pmod(x, hundred)) / hundred).cast("long")
    ends = best.groupBy("anchor").agg(
        F.array(*[F.coalesce(-whole_part(-s * low), F.lit(1)) for s in scores]).alias("lows"),
        F.array(*[F.coalesce(whole_part(s * high), F.lit(0)) for s in scores]).alias("highs"))
    windowed = stage(ends, "windows")
    raised = _own_negatives(blocks, windowed, width, kind, positives, negatives)
    ready = stage(anchors.drop("floor").join(windowed.drop("lows"), "anchor").join(raised, "anchor"), "anchors")
    chosen = _chosen(_batches(ready, positives), blocks, width, kind, positives, False)
    hits = _read(chosen, blocks, width, kind, positives, False, negatives)
    ranked = stage(_first(hits, ["anchor", "window"], negatives, "rank"), "negatives")
    discard(blocks, windowed)
    named = best.join(anchors.select("anchor", "anchor_id"), "anchor").withColumn("window", F.col("place") - 1)
    return ranked.join(named, ["anchor", "window"]).select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
                                                            F.col("score").alias("negative_score"))
