"""Running streaming queries to completion over what is available, into tables in the shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tracewell.session import new_path
from tracewell.sinks.writers import BatchWriter, by_batch


def run_available(stream: DataFrame, writer: BatchWriter, mode: str = "append", timeout: int | None = None) -> None:
    """Process everything available through a micro-batch writer, then stop."""
    query = (stream.writeStream.outputMode(mode).foreachBatch(writer).trigger(availableNow=True)
             .option("checkpointLocation", new_path(stream.sparkSession, "offsets")).start())
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        query.stop()


def run_to_table(stream: DataFrame, mode: str = "append", timeout: int | None = None) -> DataFrame:
    """Run over everything available and return what was written, with the ``batch`` it came from."""
    spark = stream.sparkSession
    path = new_path(spark, "stream")
    run_available(stream, by_batch(path), mode, timeout)
    return spark.read.parquet(path)


def latest(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of an update or complete stream's output, the last version of each key."""
    rest = [c for c in written.columns if c not in (*keys, "batch")]
    newest = written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*keys, "_r.*")
