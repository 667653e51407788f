import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracewell.functions.scale import distribution, in_parts, lookup, running_count
from tracewell.operators import metrics, outliers, topology
from tracewell.session import shared_dir, stage


def skewed(n=3000, seed=5):
    """A third of the rows under one key."""
    rnd = random.Random(seed)
    return [("hot" if rnd.random() < 0.34 else f"k{rnd.randrange(20)}", i, rnd.randrange(1, 50_000)) for i in range(n)]


def test_distribution(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, i long, v long")
    got = distribution(df, ["k"], "v", (0.5, 0.99), width=700, sums={"odd": (F.col("v") % 2)}).toPandas().set_index("k")
    want = pd.DataFrame(rows, columns=["k", "i", "v"]).groupby("k")["v"]
    for k, v in want:
        row = got.loc[k]
        assert (row["n"], row["min"], row["max"], row["odd"]) == (len(v), v.min(), v.max(), (v % 2).sum())
        assert row["mean"] == pytest.approx(v.mean())
        assert row["stddev"] == pytest.approx(np.std(v))
        assert row["p50"] == pytest.approx(np.quantile(v, 0.5))
        assert row["p99"] == pytest.approx(np.quantile(v, 0.99))


def test_distribution_counts_nulls_apart(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, v long")
    got = {r.k: r for r in distribution(df, ["k"], "v", (0.5,)).collect()}
    assert (got["a"].rows, got["a"].n, got["a"].p50) == (2, 1, 1.0)
    assert (got["b"].rows, got["b"].n, got["b"].mean, got["b"].p50) == (1, 0, None, None)


def test_distribution_of_many_large_values(spark):
    """Sums beyond a long: 3 s in microseconds, seen four million million times."""
    df = spark.createDataFrame([("a", 3_000_000, 4 * 10**12), ("a", 1_000_000, 4 * 10**12)], "k string, v long, c long")
    got = distribution(df, ["k"], "v", (0.5,), weight="c").first()
    assert (got.n, got.mean, got.stddev, got.p50) == (8 * 10**12, 2e6, 1e6, 2e6)


def test_running_count_and_distribution_on_a_hot_key(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, i long, v long")
    want = pd.DataFrame(rows, columns=["k", "i", "v"])
    got = running_count(df, ["k"], ["i"], slices=16).toPandas().set_index("i")["pos"]
    assert (got.sort_index() == (want.groupby("k").cumcount() + 1)).all()
    run = outliers.running_distribution(df, ["k"], ["i"], "v", slices=16).toPandas().set_index("i").sort_index()
    grouped = want.groupby("k")["v"].expanding()
    mean = grouped.mean().reset_index(level=0, drop=True).sort_index()
    sd = grouped.std(ddof=0).reset_index(level=0, drop=True).sort_index()
    assert np.allclose(run["run_mean"], mean) and np.allclose(run["run_sd"], sd)


def test_lookup_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, i int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert {(r.i, r.w) for r in lookup(left, right, ["k"]).collect()} == {(1, 10), (2, 20), (3, None)}


def test_running_count_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, i long")
    assert sorted(running_count(df, ["k"], ["i"]).collect(), key=repr) == sorted(df.withColumn("pos", F.col("i")).collect(), key=repr)


def test_insert_absent_knows_null_keys(spark):
    df = spark.createDataFrame([(None, "t", 1), ("a", "t", 1)], "app string, type string, v long")
    assert outliers.insert_absent(df, df, ["app", "type"], ["v"]).count() == 0


@pytest.mark.parametrize("from_zero", [False, True])
def test_pairwise_mean_equals_the_fold(spark, from_zero):
    rows = skewed(4000)
    df = spark.createDataFrame(rows, "k string, i long, v long")
    got = {r.k: r.cost for r in topology.pairwise_mean(df, ["k"], [F.col("i")], F.col("v"), from_zero).collect()}
    want = {}
    for k, _, v in rows:
        want[k] = (want[k] + v) / 2 if k in want else (v / 2 if from_zero else float(v))
    assert got == pytest.approx(want)


def test_rates_equal_the_tick_loop(spark):
    rnd = random.Random(3)
    base = 1_704_067_200_000_000
    events = sorted(rnd.randrange(0, 600_000_000) for _ in range(300))
    df = spark.createDataFrame([("k", base + e, i) for i, e in enumerate(events)], "k string, us long, i long")
    df = df.withColumn("ts", F.timestamp_micros("us"))
    end = F.timestamp_micros(F.lit(base + 900_000_000))
    got = metrics.rates(df, ["k"], "ts", end).first()
    ticks = (900_000_000 - events[0]) // 5_000_000
    for minutes, found in ((1, got.m1_rate), (5, got.m5_rate), (15, got.m15_rate)):
        a, rate = metrics.decay(minutes), None
        for t in range(ticks):
            inst = sum(1 for e in events if (e - events[0]) // 5_000_000 == t) / 5.0
            rate = inst if rate is None else rate + a * (inst - rate)
        assert found == pytest.approx(rate)


def test_parts_of_the_keys_give_the_same_rows_and_leave_no_tables(spark):
    rows = skewed()
    df = spark.createDataFrame([*rows, (None, 1, 7), (None, 2, 9)], "k string, i long, v long")
    folders = lambda: set(os.listdir(shared_dir(spark)))
    seen = []

    def work(part):
        seen.append(folders())
        return running_count(stage(part), ["k"], ["i"])
    before = folders()
    got = in_parts(df, ["k"], work, rows=600, most=4)
    assert len(seen) == 4 and all(len(s - before) <= 1 for s in seen) and len(folders() - before) == 1
    whole = lambda table: sorted(table.select("k", "i", "v", "pos").collect(), key=repr)
    assert whole(got) == whole(running_count(df, ["k"], ["i"]))
    assert len(in_parts(df, ["k"], work, rows=10_000).columns) == 4 and len(seen) == 5


def test_staging_leaves_no_shuffle_files(spark):
    files = lambda: [f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if "shuffle_" in f]
    before = set(files())
    table = stage(spark.range(1000).repartition(7).groupBy((F.col("id") % 300).alias("k")).count())
    assert not [f for f in set(files()) - before if f.endswith(".data")]
    assert table.count() == 300
