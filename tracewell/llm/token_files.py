"""Token-id files: whole documents encoded, packed with Simple-8b, written in ascending document order.

The file format is one record per segment, kept in Parquet files so that Spark's commit protocol, its
readers and any file system it knows apply: ``shard`` (its documents follow those of lower shards),
``segment``, ``first_id`` (ids before it in its shard), ``n_ids``, ``doc_ids``, ``doc_tokens`` (directory) and ``payload`` (see ``simple8b``).
A segment holds whole documents and is closed once it has ``SEGMENT_IDS`` ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tracewell.llm import simple8b
from tracewell.llm.encoding import encode_texts, encoder
from tracewell.llm.textbytes import text_buffer
from tracewell.session import prepare

SEGMENT_IDS = 1 << 16
SEGMENT = "shard long, segment long, first_id long, n_ids long, doc_ids array<long>, doc_tokens array<long>, payload binary"


def id_bounds(ids: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts`` ids that occur, ascending, cutting the rows into ranges of like size; one id per range comes back."""
    got = ids.agg(F.min(column).alias("low"), F.percentile_approx(
        column, [i / parts for i in range(1, parts)] or [0.5], 10_000).alias("cuts")).first()
    return [] if got["low"] is None else sorted({got["low"], *got["cuts"]})


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool, bounds: list[int]) -> DataFrame:
    """(doc_id, shard, n, ids): ids as little-endian 16- or 32-bit integers; shard is the range of the id."""
    cuts = np.array(bounds[1:], dtype=np.int64)
    schema = "doc_id long, shard int, n long, wide boolean, ids binary"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaced)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            numbers, wide, ids = [], [], []
            for each in encode_texts(enc, data, offsets, end_id):
                broad = bool(len(each)) and int(each.max()) > 0xFFFF
                numbers.append(len(each))
                wide.append(broad)
                ids.append(each.astype("<u4" if broad else "<u2").tobytes())
            keys = batch.column("doc_id")
            shard = np.searchsorted(cuts, keys.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays(
                [keys.cast(pa.int64()), pa.array(shard.astype(np.int32)), pa.array(numbers, pa.int64()),
                 pa.array(wide, pa.bool_()), pa.array(ids, pa.binary())], ["doc_id", "shard", "n", "wide", "ids"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, schema)


def unpack(ids: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u4" if wide else "<u2").astype(np.uint32)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents of one or more shards to segment records."""
    shard, number = None, 0
    doc_ids: list = []
    parts: list[np.ndarray] = []
    held = before = 0
    names = ["shard", "segment", "first_id", "n_ids", "doc_ids", "doc_tokens", "payload"]

    def record() -> pa.RecordBatch:
        values = [[shard], [number], [before], [held], [doc_ids], [[len(p) for p in parts]], [simple8b.encode(np.concatenate(parts))]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)
    for batch in batches:
        for doc, at, wide, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "wide", "ids"))):
            if parts and (at != shard or held >= SEGMENT_IDS):
                yield record()
                number, before = (number + 1, before + held) if at == shard else (0, 0)
                doc_ids, parts, held = [], [], 0
            shard = at
            doc_ids.append(doc)
            parts.append(unpack(ids, wide))
            held += len(parts[-1])
    if parts:
        yield record()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaced: bool = False) -> None:
    """Encode every whole text (null: empty), append ``end_id``, write the files in ascending ``doc_id`` order.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. An empty table gives no records. Rows with a
    null id come first. Rows with the same id all count, in order of their ids' bytes. Only packed ids are shuffled,
    by ranges of doc_id, so neither a hot source nor copies gather in one task.
    """
    spark = prepare(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = id_bounds(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", parts)
    encoded = encode_documents(docs, tokenizer, end_id, spaced, bounds)
    (encoded.repartitionById(max(len(bounds), 1), F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
     .mapInArrow(_segments, SEGMENT).write.parquet(path))


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, shard_start): ids of all lower shards; one row per shard, of which there are as many as ranges were cut."""
    counts = spark.read.schema(SEGMENT).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("n"))
    lower = counts.select(F.col("shard").alias("other"), F.col("n").alias("other_n"))
    return (counts.join(F.broadcast(lower), F.col("other") < F.col("shard"), "left")
            .groupBy("shard").agg(F.coalesce(F.sum("other_n"), F.lit(0)).alias("shard_start")))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): each document from the files; start counts the ids of all documents before it.

    ``ids`` are little-endian unsigned 32-bit integers, the end id included.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first, doc_ids, tokens, payload in zip(*(batch.column(c).to_pylist() for c in (
                    "shard", "first_id", "doc_ids", "doc_tokens", "payload"))):
                ids = simple8b.decode(payload)
                ends = np.cumsum(tokens)
                raw = ids.astype("<u4").tobytes()
                each = [raw[4 * (e - t):4 * e] for e, t in zip(ends.tolist(), tokens)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(np.full(len(tokens), shard)),
                     pa.array(first + ends - np.array(tokens)), pa.array(tokens, pa.int64()), pa.array(each, pa.binary())],
                    ["doc_id", "shard", "in_shard", "n_tokens", "ids"])
    table = spark.read.schema(SEGMENT).parquet(path)
    decoded = table.mapInArrow(rows, "doc_id long, shard long, in_shard long, n_tokens long, ids binary")
    return decoded.join(F.broadcast(shard_starts(spark, path)), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("in_shard")).alias("start"), "n_tokens", "ids")
