"""Near duplicates: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

1. Each text's shingle hashes fall into ``BINS`` bins by their upper bits; the smallest hash of a bin stands for it,
   an empty bin copies the first non-empty bin of a random order of its own.
2. ``ROWS`` bins make a band; documents with one band value share a bucket. With 42 bands of 6 a pair at
   resemblance 0.8 misses all buckets with chance (1 - 0.8^6)^42, about 3 in a million.
3. Texts with equal sets are one node. In a bucket only pairs with its centres, the smallest
   node and one drawn at random, are candidates. They are confirmed on the full sets.
4. Buckets that still hold several components get other centres, drawn at random and different in each bucket,
   until a turn finds no further link. Then every pair left in them is compared, block by block; a sketch of the sets,
   whose bits differ no more often than the sets do, rules out most pairs without a loss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tracewell.llm.components import bucket_links, shared_buckets
from tracewell.llm.shingles import overlap, shingle_sets
from tracewell.llm.textbytes import chunks, mix, text_buffer
from tracewell.session import prepare, stage

BIN_BITS = 8
BINS = 1 << BIN_BITS
ROWS = 6
BANDS = BINS // ROWS
SHINGLE = 5
SIMILAR = 80  # per cent
BATCH_ROWS = 512
SKETCH = 16  # 64-bit words of a sketch


def _donors() -> np.ndarray:
    """For each attempt and bin, the bin to copy from: column j is a random order of all other bins."""
    rng = np.random.default_rng(8191)
    return np.array([rng.permutation(np.delete(np.arange(BINS), j)) for j in range(BINS)]).T


DONORS = _donors()


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Densified signatures, one row of ``BINS`` values per set; rows of empty sets have no meaning."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    place = owner * BINS + (values >> np.uint64(64 - BIN_BITS)).astype(np.int64)
    first = np.ones(len(place), dtype=bool)
    first[1:] = place[1:] != place[:-1]
    flat = np.zeros(len(sets) * BINS, dtype=np.uint64)
    full = np.zeros(len(sets) * BINS, dtype=bool)
    flat[place[first]] = values[first]
    full[place[first]] = True
    sparse, filled = flat.reshape(-1, BINS), full.reshape(-1, BINS)
    out = sparse.copy()
    row, column = np.nonzero(~filled & (sizes > 0)[:, None])
    for donors in DONORS:
        if not len(row):
            break
        source = donors[column]
        hit = filled[row, source]
        out[row[hit], column[hit]] = sparse[row[hit], source[hit]]
        row, column = row[~hit], column[~hit]
    return out


def band_values(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit value per band, different between bands."""
    grouped = signatures[:, :BANDS * ROWS].reshape(len(signatures), BANDS, ROWS)
    out = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), grouped.shape[:2])
    for k in range(ROWS):
        out = mix(out * np.uint64(0xA0761D6478BD642F) + grouped[:, :, k])
    return out


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, bands): set_a and set_b are a 128-bit digest of the set."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id")
            done, sets = 0, []

            def record() -> pa.RecordBatch:
                bands = band_values(minima(sets)).view(np.int64)
                lists = [b if len(s) else b[:0] for b, s in zip(bands, sets)]
                with np.errstate(over="ignore"):
                    a = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                    b = [int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                return pa.RecordBatch.from_arrays(
                    [ids.slice(done, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(a, pa.int64()),
                     pa.array(b, pa.int64()), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_a", "set_b", "bands"])
            for s in shingle_sets(data, offsets, shingle):
                sets.append(s)
                if len(sets) == BATCH_ROWS:
                    yield record()
                    done, sets = done + len(sets), []
            if sets:
                yield record()
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(rows, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles): the full set of every wanted document, as sorted 64-bit integers."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in chunks(offsets):
                sets = [s.tobytes() for s in shingle_sets(data, offsets[i:j + 1], shingle)]
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), pa.array(sets, pa.binary())], ["node", "shingles"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.join(wanted, "doc_id", "left_semi").mapInArrow(rows, "node long, shingles binary")


def sketch(values: np.ndarray) -> np.ndarray:
    """``SKETCH`` words: for each bit, whether an odd number of the set's values falls on it. Sets that differ in d values differ in d bits at most."""
    odd = np.bincount((values & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _refined(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Members whose n has the sketch of the node's set beside its size."""
    fields = [f"s{k}" for k in range(SKETCH)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([sketch(np.frombuffer(v.as_buffer(), dtype=np.uint64)) for v in batch.column("shingles")], dtype=np.int64).reshape(-1, SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array(np.ascontiguousarray(c)) for c in made.T)], ["node", *fields])
    # an id with several texts has a row for each of them, and is compared by all
    made = sets.join(rest.select("node").distinct(), "node", "left_semi").mapInArrow(rows, "node long, " + ", ".join(f"{f} long" for f in fields))
    return rest.join(made, "node").withColumn("n", F.struct(F.col("n").alias("size"), *fields))


def _refined_condition(similar: int) -> str:
    """Sizes allow a resemblance of ``similar`` per cent, and the sketches differ no more than the sets then may."""
    apart = " + ".join(f"bit_count(n.s{k} ^ m.s{k})" for k in range(SKETCH))
    return (f"100 * least(n.size, m.size) >= {similar} * greatest(n.size, m.size) AND "
            f"({apart}) * (100 + {similar}) <= (100 - {similar}) * (n.size + m.size)")


def _confirmed(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """The pairs (a, b) whose sets share at least ``similar`` per cent of their union."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = overlap(x, y) if 100 * min(len(x), len(y)) >= similar * max(len(x), len(y)) else 0
                keep.append(both > 0 and 100 * both >= similar * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(rows, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, links.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever their names. A text's set: the distinct
    ``shingle``-word sequences; with fewer words, the whole as one; null, empty and blank texts have an empty set
    and are linked with nothing. Documents with 100 * intersection >= ``similar`` * union are linked; component_id is the
    smallest doc_id reachable, ``links`` the number of confirmed links of the document's set to other sets. Rows with one id and
    several texts are linked text by text; texts with the same smallest id are one node. A row with a null id is linked with
    nothing and kept.
    """
    prepare(docs.sparkSession)
    signed = stage(signatures(docs, shingle), "signatures")
    key = ["n_shingles", "set_a", "set_b"]
    whole = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # texts with equal sets have equal bands
    classes = stage(whole.groupBy(*key).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "classes")
    rows = classes.select(F.explode("bands").alias("bucket"), "node", F.col("n_shingles").alias("n"))
    members = stage(shared_buckets(rows), "buckets")
    sets = stage(_sets(docs, members.select(F.col("node").alias("doc_id")).distinct(), shingle), "sets")
    links, found = bucket_links(members, lambda pairs: _confirmed(pairs, sets, similar),
                                f"100 * least(n, m) >= {similar} * greatest(n, m)",
                                refine=lambda rest: _refined(rest, sets), refined=_refined_condition(similar))
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count("*").alias("links"))
    placed = stage(classes.join(found, "node", "left").join(degree, "node", "left").select(
        *key, F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links")), "placed")
    result = signed.drop("bands").join(placed, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                         F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0))).otherwise(0).alias("links"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, similar: int = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that are kept, one per component, all columns as they were."""
    no_id = F.lit(-(1 << 63))
    kept = near_duplicates(docs, shingle, similar).where("kept").select(F.coalesce("doc_id", no_id).alias("__tw_id")).distinct()
    rows = docs.withColumn("__tw_id", F.coalesce(F.col("doc_id").cast("long"), no_id)).join(kept, "__tw_id", "left_semi")
    order = Window.partitionBy("__tw_id").orderBy(F.xxhash64(F.col("text")), "text")
    return rows.withColumn("__tw_row", F.row_number().over(order)).where("__tw_row = 1 OR doc_id IS NULL").select(*docs.columns)
