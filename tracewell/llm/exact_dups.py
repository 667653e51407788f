"""Exact duplicates of whole texts by salted, content-comparing aggregation; DataFrame functions only.

A text's class is its white-space-normalised content. Every grouping has the content itself among its
keys, next to its digest, so texts are compared in full at every stage:

1. within a task, Spark's partial aggregation leaves one row per content (local deduplication);
2. these rows are merged per (digest, salt), the salt being taken from the task, so that copies of one
   text from many tasks meet in several places instead of one;
3. the salts' winners are combined per content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tracewell.session import prepare, stage

SALTS = 8
NO_ID = -(1 << 63)


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one blank; null becomes the empty text."""
    # single blanks, the bulk of all runs, are not touched
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\t-\r][ \t-\r]*| [ \t-\r]+", " ")


def digest(content: Column) -> Column:
    """SHA-256 in binary; never null, so that joins on it add no null filter, which would work it out twice."""
    return F.coalesce(F.unhex(F.sha2(content, 256)), F.lit(b""))


def _content(docs: DataFrame) -> DataFrame:
    content = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("content"))
    return content.withColumn("digest", digest(F.col("content")))


def groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """(digest, keep_id, group_size): one row per different content, with its smallest id and its number of rows."""
    salted = _content(docs).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "content").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("size"))
    merged = winners.groupBy("digest", "content").agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("group_size"))
    # Two contents with one SHA-256 digest would make the join below ambiguous; none are known. Say so rather than mix them.
    single = merged.groupBy("digest").agg(F.count("*").alias("contents"), F.min("keep_id").alias("keep_id"),
                                          F.min("group_size").alias("group_size"))
    checked = F.when(F.col("contents") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("different texts share a SHA-256 digest")).cast("long"))
    return single.select("digest", "keep_id", checked.alias("group_size"))


def exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever their names. Null texts count as
    empty, empty texts are copies of each other. The smallest doc_id of a content is kept; null ids come after all
    others (keep_id is null if a content has no other). Of repeated rows with one id and content, one is kept.
    """
    prepare(docs.sparkSession)
    rows = _content(docs).groupBy("doc_id", "digest").agg(F.count("*").alias("rows"))
    # a table of its own: the copies of one content then meet it in as many tasks as AQE splits them into
    matched = rows.join(stage(groups(docs, salts), "contents"), "digest")
    each = matched.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select("doc_id", "keep_id", "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    # the same two keys serve the join and the window, so whole rows are shuffled once; no id stands for a null one
    def id_key(column: str) -> Column:
        return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))
    kept = groups(docs, salts).select(id_key("keep_id").alias("__tw_id"), F.col("digest").alias("__tw_digest"))
    marked = docs.withColumn("__tw_id", id_key("doc_id")).withColumn("__tw_digest", digest(normalised(F.col("text"))))
    rows = marked.join(kept, ["__tw_id", "__tw_digest"], "left_semi")
    order = Window.partitionBy("__tw_id", "__tw_digest").orderBy(F.lit(0))
    return rows.withColumn("__tw_row", F.row_number().over(order)).where("__tw_row = 1").select(*docs.columns)
