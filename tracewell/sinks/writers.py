"""Writers: topics, daily and per-window tables, shards, insert-if-absent, snapshots and fan-out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tracewell.functions import expressions as E
from tracewell.operators import outliers

BatchWriter = Callable[[DataFrame, int], None]


def topic_rows(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def value_rows(df: DataFrame, key: Column, count: Column, separator: str = "\t") -> DataFrame:
    """Value-only topic rows ``key<separator>count``."""
    return df.select(E.key_count_line(key, count, separator).alias("value"))


def to_topic(stream: DataFrame, brokers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Stream of ``(key, value)`` into a topic, compressed; needs the Kafka connector package."""
    return (stream.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic)
            .option("kafka.compression.type", "gzip").option("checkpointLocation", checkpoint))


def write_topic_dump(df: DataFrame, path: str, topic: str) -> None:
    """``(key, value)`` rows as parquet files in the shape of topic rows."""
    df.select(F.lit(topic).alias("topic"), "key", "value", F.current_timestamp().alias("timestamp")).write.mode(
        "append").parquet(path)


def with_day(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("day", F.to_date(ts))


def write_daily(df: DataFrame, path: str, ts: str, form: str = "parquet", mode: str = "append") -> None:
    """Write a table with one folder per day; rebalancing gives each day as many writers as its size needs."""
    with_day(df, ts).hint("rebalance", "day").write.mode(mode).partitionBy("day").format(form).save(path)


def daily_by_batch(path: str, ts: str) -> BatchWriter:
    """Micro-batch writer into daily folders below one of the batch, so that a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_daily(batch, f"{path}/batch={batch_id}", ts, mode="overwrite")
    return write


def write_per_window(df: DataFrame, path: str, ts: str, seconds: int, shards: int, line: Column) -> None:
    """One folder per time window and shard holding text lines; shards split a busy window."""
    start = E.bucket_start(F.col(ts), seconds)
    rows = df.select(
        line.cast("string").alias("value"), F.date_format(start, "yyyyMMdd-HHmm").alias("w_start"),
        F.date_format(start + F.make_dt_interval(secs=F.lit(seconds)), "yyyyMMdd-HHmm").alias("w_end"))
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("value"), F.lit(shards)).cast("int"))
    (sharded.repartition("w_start", "shard").write.mode("append")
     .partitionBy("w_start", "w_end", "shard").text(path))


def write_shards(df: DataFrame, path: str, shards: int, line: Column) -> None:
    """Text lines in a fixed number of files."""
    df.select(line.cast("string").alias("value")).repartition(shards).write.text(path)


def write_snapshot(df: DataFrame, path: str, at: str, interval: str) -> None:
    """One interval's snapshot into a daily table; writing the same interval again replaces it."""
    (df.withColumn("day", F.to_date(F.lit(at))).withColumn("interval", F.lit(interval)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day", "interval").parquet(path))


def insert_absent(path: str, at: str, keys: Sequence[str] = outliers.KEPT_KEYS) -> BatchWriter:
    """Micro-batch writer into daily folders that appends only rows whose key the table of their day (of column ``at``) does not hold yet.

    Only the keys of the batch's days are read, so that this does not grow with the table.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_day(batch, at)
        days = [r["day"] for r in rows.select("day").distinct().collect()]     # a micro-batch spans a few days
        stored = None
        if days and _exists(spark, path):
            stored = spark.read.schema(rows.schema).parquet(path).where(F.col("day").isin(days))
        new = outliers.insert_absent(rows, stored, ["day", *keys], (at, "row_key"))
        new.write.mode("append").partitionBy("day").parquet(path)
    return write


def _exists(spark, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def by_batch(path: str) -> BatchWriter:
    """Micro-batch writer with one folder per batch, so that a repeated batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """Micro-batch writer that hands the same batch, computed once, to several writers."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for writer in writers:
                writer(batch, batch_id)
        finally:
            batch.unpersist()
    return write
