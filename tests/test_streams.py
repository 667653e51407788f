import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from tracewell.operators import joins, outliers
from tracewell.session import new_path
from tracewell.sinks import writers
from tracewell.streaming import runs, traces, windows

# Addresses, times and areas of the small access-log sample.
AREAS = [("1.119.132.165", "北京"), ("94.180.155.98", "俄罗斯")]
ACCESS = [(ip, f"2010-05-04 {h}") for ip, times in (
    ("1.119.132.165", ["12:34:23"] * 3 + ["13:34:23"]), ("119.4.252.140", ["12:45:23"] * 3 + ["14:45:23"]),
    ("94.180.155.98", ["12:47:23"] * 3 + ["15:47:23"])) for h in times]


def test_sliding_counts_by_area(spark):
    rows = spark.createDataFrame(ACCESS, "ip string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    known = joins.area_lookup(rows, spark.createDataFrame(AREAS, "ip string, area string"), "ip")
    got = windows.windowed_counts(known, "ts", F.col("area"), "60 seconds", "5 seconds").collect()
    assert Counter((r.key, r.n) for r in got) == {
        (area, n): 12 for area in ("北京", "未知地域", "俄罗斯") for n in (1, 3)}


def test_stream_over_several_batches_equals_the_batch(spark):
    path = new_path(spark, "in")
    rows = spark.createDataFrame(ACCESS, "ip string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(3).write.parquet(path)
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    for mode in ("update", "complete"):
        written = runs.run_to_table(windows.running_counts(source, F.col("ip")), mode)
        assert {(r.key, r.n) for r in runs.latest(written, ["key"]).collect()} == {(ip, 4) for ip in {a for a, _ in ACCESS}}


def batches(spark, rows, *picks):
    """A stream of one file for each list of row numbers."""
    path = new_path(spark, "spans")
    rows = rows.withColumn("_nr", F.col("row_key").cast("int"))
    for pick in picks:
        rows.where(F.col("_nr").isin(pick)).drop("_nr").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.drop("_nr").schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_traces_close_after_sixteen_idle_minutes(spark, make_spans):
    minute = 60
    spans = make_spans(
        dict(trace="a", id="1", at=0), dict(trace="a", id="2", at=15 * minute, parent="1", tags={"error": "500"}, local="x"),   # one session of two
        dict(trace="b", id="1", at=16 * minute), dict(trace="a", id="3", at=32 * minute),                                   # a's next one
        dict(trace="c", id="1", at=100 * minute), dict(trace="a", id="4", at=14 * minute), dict(trace="d", id="1", at=200 * minute))
    #  spans 0 and 3 come again; span 5 comes when its session has closed
    stream = batches(spark, spans, [1, 3], [0, 2], [0, 3], [4], [5], [6])
    out = runs.run_to_table(traces.assemble(stream, "20 minutes")).cache()
    closed = {(r.trace_id, r.span_id, r.session_start.minute) for r in out.where("outcome = 'closed'").collect()}
    assert closed == {("a", "1", 0), ("a", "2", 0), ("b", "1", 16), ("a", "3", 32), ("c", "1", 40)}
    assert [(r.trace_id, r.span_id, r.session_start) for r in out.where("outcome = 'late'").collect()] == [("a", "4", None)]
    assert {(r.session_start.minute, r.times) for r in out.where("outcome = 'repeated'").collect()} == {(0, 1), (32, 1)}
    # all but the span whose session is still open
    assert out.agg(F.sum("times")).first()[0] == 9 - 1
    whole = lambda df: sorted(map(str, df.select(spans.columns).collect()))
    assert whole(out.where("outcome = 'closed'")) == whole(spans.where("row_key NOT IN (5, 6)"))


def test_trace_assembly_of_shuffled_spans_equals_the_batch(spark, make_spans):
    import random
    rng = random.Random(8)
    rows = [dict(trace=f"t{rng.randrange(12)}", id=str(i), at=rng.randrange(40_000)) for i in range(300)]
    spans = make_spans(*rows)
    order = sorted(range(300), key=lambda i: rows[i]["at"] + rng.randrange(1_200))
    stream = batches(spark, spans, *[order[k:k + 30] for k in range(0, 300, 30)])
    out = runs.run_to_table(traces.assemble(stream, "20 minutes"))
    got = {(r.trace_id, r.span_id): r.session_start.timestamp() for r in out.where("outcome = 'closed'").collect()}
    assert out.where("outcome != 'closed'").count() == 0
    want, end = {}, max(r["at"] for r in rows) - 1_200
    for trace in {r["trace"] for r in rows}:
        sessions = []
        for r in sorted((r for r in rows if r["trace"] == trace), key=lambda r: r["at"]):
            if not sessions or r["at"] >= sessions[-1][-1]["at"] + 960:
                sessions.append([])
            sessions[-1].append(r)
        want |= {(trace, r["id"]): s[0]["at"] for s in sessions if s[-1]["at"] + 960 <= end for r in s}
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    assert {k: round(v - base) for k, v in got.items()} == want and len(want) > 250


def test_insert_absent_and_snapshot_are_repeatable(spark):
    path = new_path(spark, "kept")
    at = dt.datetime(2024, 1, 1)
    def hits(*ids):
        return spark.createDataFrame([("t", "COST", "a", i, f"{i}{k}", at) for i in ids for k in "xy"],
                                     "trace_id string, type string, app string, span_id string, row_key string, create_time timestamp")
    write = writers.insert_absent(path, "create_time")
    for batch in (hits("1", "2"), hits("2", "3"), hits("1")):
        write(batch, 0)
    assert sorted(r.row_key for r in spark.read.parquet(path).collect()) == ["1x", "2x", "3x"]


def test_running_distribution_flags_slow_spans(make_spans):
    from tracewell.operators import spans as S
    rows = [dict(id=str(i), trace=f"t{i}", local="a", name="/x", duration=d) for i, d in enumerate((10, 10, 12, 40))]
    slow = outliers.slow_spans(S.normalize(make_spans(*rows)))
    assert sorted(r.span_id for r in slow.collect()) == ["2", "3"]


def test_moments_go_on_between_batches(spark, make_spans):
    from tracewell.operators import spans as S
    from tracewell.streaming import summaries
    import random
    rng = random.Random(3)
    spans = S.normalize(
        make_spans(*[dict(trace=f"t{i}", id=str(i), at=i // 2, local="ab"[i % 2], name=("/x", "/y")[i % 3 == 0], duration=rng.randrange(1, 90),
                          tags={"error": rng.choice(("200", "500"))}) for i in range(120)]))
    for daily in (False, True):
        state, path = new_path(spark, "moments"), new_path(spark, "kept")
        write = summaries.keep_traces(state, writers.by_batch(path), daily=daily)
        cuts = [0, 10, 30, 31, 60]
        for k, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            part = spans.where(f"unix_seconds(ts) - unix_seconds(timestamp'2024-01-01') >= {low} AND unix_seconds(ts) - unix_seconds(timestamp'2024-01-01') < {high}")
            for _ in range(1 + (k == 2)):       # a batch that is run again changes nothing
                write(part, k)
        whole = lambda df: sorted(map(str, df.select("app", "type", "trace_id", "span_id", "row_key", "duration", "create_time").collect()))
        assert whole(spark.read.parquet(path)) == whole(outliers.kept_traces(spans, daily=daily))


def test_rates_go_on_between_batches(spark):
    from tracewell.operators import metrics
    from tracewell.streaming import summaries
    import random
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    made = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), start + dt.timedelta(milliseconds=rng.randrange(0, 3_500_000))) for _ in range(600)]
    rows = spark.createDataFrame(made, "k string, ts timestamp").withColumn("w", F.window("ts", "15 minutes").start).cache()
    end = F.col("w") + F.expr("INTERVAL 15 MINUTES")
    state, path = new_path(spark, "rates"), new_path(spark, "reported")
    write = summaries.rate_writer(state, writers.by_batch(path), ["k", "w"], "ts", end, late=300)
    # the first rows of each key and interval come in time, others up to five minutes late
    second = F.unix_seconds("ts") - int(start.timestamp())
    delay = F.when(F.pmod(second, F.lit(900)) < 300, 0).otherwise(F.pmod(F.xxhash64("ts"), F.lit(250)))
    arrives = F.floor((second + delay) / 450)
    for k in range(9):
        for _ in range(1 + (k == 3)):       # a batch that is run again changes nothing
            write(rows.where(arrives == k), k)
    write(rows.where("false"), 9)
    write(spark.createDataFrame([("end", start + dt.timedelta(hours=2), start + dt.timedelta(hours=2))], rows.schema), 10)
    write(spark.createDataFrame([("hot", start + dt.timedelta(seconds=5), start)], rows.schema), 11)     # its interval has come out
    values = lambda df: {(r.k, r.w): (r.total, *(round(r[c], 9) for c in ("mean_rate", "m1_rate", "m5_rate", "m15_rate"))) for r in df.collect()}
    got, want = spark.read.parquet(path), metrics.rates(rows, ["k", "w"], "ts", end)
    assert values(got) == values(want) and got.count() == want.count() == 16


def test_panes_fire_again_after_three_late_rows(spark):
    from tracewell.streaming import panes
    path = new_path(spark, "in")

    def put(*seconds):
        rows = [("k", dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)) for s in seconds]
        spark.createDataFrame(rows, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    # windows of ten seconds: rows at 1, 2; time passes to 12; one and one late row; one more (the third); one after the third; time passes everything
    for batch in ((1, 2), (12,), (12, 3), (4,), (5,), (6,), (100,), (101, 7), (200,)):
        put(*batch)
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    out = runs.run_to_table(panes.fired_counts(stream, "ts", F.col("k"), 10, 10, 30))
    first = [(r.firing, r.n) for r in out.where("w_start = timestamp'2024-01-01'").orderBy("batch", "n").collect()]
    assert first == [("early", 2), ("on time", 2), ("late", 5), ("last", 6)]
    assert [(r.firing, r.n) for r in out.where("w_start = timestamp'2024-01-01 00:00:10'").orderBy("batch", "n").collect()] == [
        ("early", 1), ("early", 2), ("on time", 2)]


def test_panes_ask_the_state_per_block(spark):
    from tracewell.streaming import panes
    path = new_path(spark, "in")
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    seconds = [s for k in range(3) for s in range(100 * k, 100 * k + 100, 7 - k)]
    for k in range(3):
        made = [(key, base + dt.timedelta(seconds=s)) for s in seconds if s // 100 == k for key in ("a", None)]
        spark.createDataFrame(made, "k string, ts timestamp").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    fired = panes.fired_counts(stream, "ts", F.col("k"), 15, 5, 30, block=4)      # windows of 15 seconds go over the bounds of blocks of 20
    assert "block" in fired._jdf.queryExecution().analyzed().toString()
    got = {(r.key, round((r.w_start - base.replace(tzinfo=None)).total_seconds())): r.n
           for r in runs.run_to_table(fired).groupBy("key", "w_start").agg(F.max("n").alias("n")).collect()}
    want = Counter((key, s // 5 * 5 - back) for s in seconds for back in (0, 5, 10) for key in ("a", None))
    assert got == want


def test_sliding_counts_from_panes_equal_direct_ones(spark):
    rows = spark.createDataFrame(ACCESS, "ip string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    both = [sorted(map(tuple, windows.windowed_counts(rows, "ts", F.col("ip"), "60 seconds", "5 seconds", panes=p).collect())) for p in (True, False)]
    assert both[0] == both[1] and len(both[0]) > 60


def rule_events(spark, *batches):
    from tracewell.streaming import rules
    path = new_path(spark, "events")
    for batch in batches:
        rows = [(r, kind, dt.datetime.fromtimestamp(at, dt.timezone.utc), n, on, 60, 300, 1) for r, kind, at, n, on in batch]
        spark.createDataFrame(rows, rules.EVENT).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rules.EVENT).option("maxFilesPerTrigger", 1).parquet(path)
    return {(r.rule_id, r.tick): (r.matches, r.fired) for r in runs.run_to_table(rules.run_rules(stream)).collect()}


def test_rules_run_by_timers(spark):
    base = 1_704_067_200
    def hit(rule, at, n=1):
        return (rule, "hits", base + at, n, None)
    def rule(number, at, on):
        return (number, "rule", base + at, None, on)
    beat = lambda at: (None, "beat", base + at, None, None)
    got = rule_events(spark, [rule(1, 0, True), rule(2, 0, True)], [hit(1, 10, 2), hit(1, 30), hit(2, 20)], [hit(1, 130), beat(200)],
                      [rule(2, 205, False)], [hit(2, 210), rule(2, 290, True), hit(2, 300), hit(1, 290)], [hit(1, 310), beat(1_000)])
    assert {(r, t - base): v for (r, t), v in got.items()} == {
        (1, 60): (3, False), (1, 180): (1, True), (1, 300): (1, True), (1, 360): (1, False),
        (2, 60): (1, False), (2, 350): (1, False)}


def test_snapshots_of_a_day_so_far(spark):
    import random
    import numpy as np
    from tracewell.operators import snapshots
    rng = random.Random(12)
    rows = [(rng.choice(("a", "b", None)), dt.datetime(2024, 1, 1 + rng.randrange(2), rng.randrange(24), rng.randrange(60), tzinfo=dt.timezone.utc),
             rng.choice((None, rng.randrange(-50, 50), rng.randrange(10 ** 6), rng.randrange(10 ** 15)))) for _ in range(900)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v long")
    hist = snapshots.interval_histograms(df, ["k"], "ts", "v")
    got = {(r.k, r.w.timestamp()): r for r in snapshots.day_to_date(hist, ["k"], (0.5, 0.95)).collect()}
    active = {(k, t.timestamp() // 900 * 900) for k, t, _ in rows}
    assert set(got) == active
    for k, w in active:
        r = got[k, w]
        day = w // 86_400
        seen = [v for kk, t, v in rows if kk == k and v is not None and t.timestamp() // 86_400 == day and t.timestamp() < w + 900]
        assert r.total == sum(1 for kk, t, _ in rows if kk == k and t.timestamp() // 900 * 900 == w)
        if not seen:
            assert r.n is None
            continue
        assert (r.n, r.min, r.max) == (len(seen), min(seen), max(seen))
        assert np.allclose([r.mean, r.p50, r.p95], [np.mean(seen), *np.percentile(seen, [50, 95])])


def test_cells_ascend(spark):
    from tracewell.operators import snapshots
    values = sorted({s * (2 ** k + d) for k in range(62) for d in (-1, 0, 1) for s in (-1, 1)} | set(range(-200, 200)))
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", snapshots.cell(F.col("v")).alias("c")).collect()
    cells = [r.c for r in sorted(got, key=lambda r: r.v)]
    assert cells == sorted(cells) and len(set(cells)) < 4_100
    assert len({r.c for r in got if 0 <= r.v < 64}) == 64


def test_a_long_stretch_is_replayed_from_several_files(spark, monkeypatch):
    from tracewell.plans import streams
    monkeypatch.setattr(streams, "REPLAY_ROWS", 100)
    rows = spark.range(1_000).select("id", F.timestamp_seconds(F.when(F.col("id") < 700, F.col("id") % 100).otherwise(F.col("id"))).alias("ts"))
    seen = []
    runs.run_available(streams.replayed_in_order(rows, "ts"), lambda batch, batch_id: seen.append(
        (batch.select(F.input_file_name()).distinct().count(), sorted(r.id for r in batch.collect()))))
    want = [[r.id for r in rows.where(f"unix_seconds(ts) >= {200 * k} AND unix_seconds(ts) < {200 * k + 200}").orderBy("id").collect()] for k in range(5)]
    assert [ids for _, ids in seen] == want and [n for n, _ in seen] == [7, 0, 0, 1, 2]


def test_traces_share_the_state_of_their_bucket(spark, make_spans):
    spans = make_spans(*[dict(trace=f"t{i}", id="1", at=i) for i in range(400)], dict(trace="end", id="1", at=10_000), dict(trace="end", id="2", at=20_000))
    found = traces.assemble(batches(spark, spans, list(range(400)), [400], [401]), "0 seconds")
    assert "bucket" in found._jdf.queryExecution().analyzed().toString()
    out = runs.run_to_table(found)
    assert {r.trace_id for r in out.where("outcome = 'closed'").collect()} >= {f"t{i}" for i in range(400)}
