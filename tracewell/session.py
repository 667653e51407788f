"""Session settings and durable cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster session should carry. AQE coalesces small shuffle partitions and
# splits skewed join partitions; forcing it lets it do so even where an extra exchange is needed.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # what a Python worker holds at once, however long the texts of its rows are
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_staged: list[tuple[SparkSession, str]] = []
_scratch: dict[str, str] = {}  # the folder of a local session that names none, by application


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; safe to call repeatedly."""
    for key, value in RECOMMENDED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Taken from ``spark.checkpoint.dir``. A local session without the setting gets a scratch
    folder; a cluster session must name one, since executors cannot share a local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _scratch:
        _scratch[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _scratch[application]


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back: lineage ends here, and the shuffle files of the write go with it."""
    path = new_path(df.sparkSession, label)
    with short_shuffles(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True))


def discard(*tables: DataFrame | None) -> None:
    """Delete staged tables that nothing will read again; other frames and None are left alone."""
    for table in tables:
        path = getattr(table, "staged_at", None)
        if path is not None:
            _delete(table.sparkSession, path)
            _staged[:] = [entry for entry in _staged if entry[1] != path]


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, Spark deletes the shuffle files of each query when it ends; for jobs whose steps are all staged, as a frame run twice would shuffle again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def only_kept(spark: SparkSession, *paths: str) -> Iterator[list[str]]:
    """Within, tables are staged for the time being: in the end all are deleted but those at ``paths``, and at the paths added to the list given."""
    before, kept = {path for _, path in _staged}, list(paths)
    try:
        yield kept
    finally:
        for owner, path in list(_staged):
            if path not in before and path not in kept:
                _delete(owner, path)
                _staged.remove((owner, path))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the ``batch=`` folders below ``path`` whose table was written to its end, ascending."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    found = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
    return [v for v in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch={v}/_SUCCESS"))]


def release(spark: SparkSession) -> int:
    """Delete the tables staged through this session; returns how many were removed."""
    removed = 0
    for owner, path in list(_staged):
        if owner is spark:
            removed += _delete(spark, path)
            _staged.remove((owner, path))
    return removed
