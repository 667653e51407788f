"""Readers for topics, text, JSON lines and stored result tables; batch and stream share one shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tracewell import schemas


def topic_options(brokers: str, topics: Sequence[str], group: str, offset: str = "latest",
                  fail_on_loss: bool = True) -> dict[str, str]:
    """Options of the Kafka source; lost offsets end the query unless the caller accepts the gap."""
    return {"kafka.bootstrap.servers": brokers, "subscribe": ",".join(topics), "kafka.group.id": group,
            "startingOffsets": offset, "failOnDataLoss": str(fail_on_loss).lower()}


def topic_records(raw: DataFrame) -> DataFrame:
    """Key and value of topic rows as text."""
    return raw.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                      F.col("timestamp"))


def read_topics(spark: SparkSession, brokers: str, topics: Sequence[str], group: str,
                offset: str = "latest") -> DataFrame:
    """Stream of topic records; needs the Kafka connector package on the cluster."""
    options = topic_options(brokers, topics, group, offset)
    return topic_records(spark.readStream.format("kafka").options(**options).load())


def read_topic_dump(spark: SparkSession, path: str, topics: Sequence[str]) -> DataFrame:
    """Stream over parquet files holding topic rows, for replays."""
    rows = spark.readStream.schema(schemas.TOPIC).parquet(path)
    return topic_records(rows.where(F.col("topic").isin(*topics)))


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).text(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType = schemas.ENVELOPE,
                    stream: bool = True) -> DataFrame:
    """Rows of JSON-lines files; as a stream it follows files added to the folder."""
    return (spark.readStream if stream else spark.read).schema(schema).json(path)


def read_table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream over a stored table, one file or a folder of part files.

    What is there is one micro-batch, so a watermark drops nothing of a replay whatever the order of its files;
    ``files_per_trigger`` cuts it for sources whose files follow event time.
    """
    path = f"{folder}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    reader = reader if files_per_trigger is None else reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder}/{name}.parque[t]")  # a pattern may name a file as well as a folder


def read_results(spark: SparkSession, path: str, predicate: Column | None = None, first_day: str | None = None,
                 last_day: str | None = None) -> DataFrame:
    """Rows of a day-partitioned result table; days outside the range are not read."""
    rows = spark.read.parquet(path)
    if first_day is not None:
        rows = rows.where(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.where(F.col("day") <= F.lit(last_day).cast("date"))
    return rows if predicate is None else rows.where(predicate)
