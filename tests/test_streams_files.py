"""Stream queries over tables that are folders of part files, in one batch and in many."""

import pytest

from check import compare, engine
from conftest import SMALL
from __spark_entry__ import oracle_sql, queries
from tracewell.operators import metrics
from tracewell.session import new_path
from tracewell.sources import derived, readers
from tracewell.streaming import runs, windows

STREAMS = ["sink_fanout", "cdc_relay", "win_tumbling_10s", "win_fixed_5s", "win_sliding_late", "running_count", "stream_traces",
           "stream_topology"]


@pytest.fixture(scope="module")
def parts(spark):
    """The streamed tables as folders of part files."""
    folder = new_path(spark, "parts")
    for name in ("events", "lineitem", "orders"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").repartition(5).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", STREAMS)
def test_folder_of_parts(spark, parts, name):
    want = engine(SMALL).execute(oracle_sql()[name]).df()
    assert compare(queries()[name](spark, parts).toPandas(), want) == ""


def test_one_file_per_batch(spark, parts):
    stream = derived.access_columns(readers.read_table_stream(spark, parts, "events", files_per_trigger=1))
    many = runs.run_to_table(windows.running_counts(stream, stream["uri"]), "complete")
    assert many.select("batch").distinct().count() == 5
    want = {r["uri"]: r["total"] for r in metrics.counts(derived.access(spark, SMALL), ["uri"]).collect()}
    assert {r["key"]: r["n"] for r in runs.latest(many, ["key"]).collect()} == want
