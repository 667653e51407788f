import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tracewell.session import prepare
    session = (SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture
def make_spans(spark):
    """Spans from dicts; times are seconds, missing fields are null."""
    import datetime as dt

    from tracewell import schemas

    def build(*rows):
        out = []
        for i, r in enumerate(rows):
            at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=r.get("at", i))
            out.append((r.get("trace", "t"), r["id"], r.get("parent"), r.get("kind"), r.get("name", "/" + r["id"]), at,
                        r.get("duration", 10), r.get("local"), r.get("remote"),
                        r.get("tags", {"tracingtype": "http"}), r.get("key", str(i))))
        return spark.createDataFrame(out, schemas.SPAN)
    return build
