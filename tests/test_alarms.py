import pytest
from pyspark.sql import functions as F

from tracewell.functions import conditions
from tracewell.operators import alarms
from tracewell.session import new_path
from tracewell.streaming import runs, stateful

MATCHES = [(1, t, 1, 300, 3) for t in (0, 60, 120, 180, 240, 300)]
SCHEMA = "rule_id long, tick long, matches long, throttle long, threshold long"


def test_throttle_golden_batch_and_stream(spark):
    df = spark.createDataFrame(MATCHES, SCHEMA)
    batch = {r.tick: r.fired for r in alarms.throttle(df).collect()}
    assert [t for t, fired in batch.items() if fired] == [180, 240]
    path = new_path(spark, "matches")
    df.coalesce(1).write.parquet(path)
    stream = stateful.throttle_stream(spark.readStream.schema(SCHEMA).parquet(path))
    assert {r.tick: r.fired for r in runs.run_to_table(stream, "update").collect()} == batch


def test_conditions(spark):
    hits = spark.createDataFrame([("ERROR", 5), ("COST", 3_000_000), ("COST", 10)], "type string, duration long")
    both = '{"range":{"span.duration":{"gte":3000000,"lt":4000000}}},{"term":{"type":"COST"}}'
    assert [r.duration for r in hits.where(conditions.predicate(both)).collect()] == [3_000_000]
    with pytest.raises(ValueError):
        conditions.predicate('{"match":{"type":"x"}}')
    with pytest.raises(ValueError):
        conditions.predicate('{"term":{"nothing":"x"}}')


def test_schedule_forgets_disabled_rules(spark):
    rows = [(1, t, 120, on) for t, on in ((0, True), (60, True), (120, True), (180, False), (240, True))]
    df = spark.createDataFrame(rows, "rule_id long, tick long, frequency long, on boolean")
    assert sorted(r.tick for r in alarms.schedule(df).collect()) == [0, 120, 240]


def test_ttl_max(spark):
    from tracewell.operators import metrics
    df = spark.createDataFrame([("k", 0, 5.0), ("k", 10, 3.0), ("k", 14, 4.0), ("k", 15, 1.0), ("k", 16, 2.0)],
                               "k string, t long, v double")
    got = [r.v_max for r in metrics.largest_alive(df, ["k"], "t", "v", 15).orderBy("t").collect()]
    assert got == [5.0, 5.0, 5.0, 1.0, 2.0]


def test_rules_and_actions(spark):
    df = spark.createDataFrame([(1, "a", True, 1), (1, "b", True, 2), (2, "c", None, 1)],
                               "id long, title string, enable boolean, version int")
    assert sorted((r.id, r.title) for r in alarms.upsert(df, "version").collect()) == [(1, "b"), (2, "c")]
    assert alarms.enabled(df, None).count() == 3 and alarms.enabled(df).count() == 2
    rules = spark.createDataFrame([(1, "t", [("n", "sms", None, "x", "s", "m"), ("n", "pager", None, "y", "s", "m")])],
                                  "id long, title string, actions array<struct<name:string,type:string,`from`:string,"
                                  "`to`:string,subject:string,msg:string>>")
    fired = spark.createDataFrame([(1, 60)], "rule_id long, tick long")
    assert sorted(r.type for r in alarms.actions(fired, rules).collect()) == ["DEFAULT", "SMS"]


def test_rules_join_hits(spark):
    hit = "app string, type string, trace_id string, span_id string, row_key string, span_name string, duration long, create_time timestamp"
    hits = spark.createDataFrame([("a", "COST", "t1", "1", "", "/x", 5, None), ("b", "ERROR", "t2", "2", "", "/y", 50, None),
                                  (None, "ERROR", "t3", "3", "", None, None, None)], hit).withColumn("create_time", F.lit("2024-01-01").cast("timestamp"))
    texts = {1: '{"term":{"app.keyword":"a"}}', 2: '{"term":{"type":{"value":"ERROR"}}},{"range":{"span.duration":{"gt":5}}}',
             3: '{"range":{"createTime":{"from":"2023-12-31","lt":"2024-01-02"}}}', 4: '{"term":{"span.duration":5}}', 5: "not json",
             6: '{"term":{"nothing":"x"}}', 7: '{"range":{"span.duration":{}}}', 8: '{"match":{"type":"x"}}', 9: "", 10: '{"term":{"type":"COST"}}'}
    rules = spark.createDataFrame([(i, i != 10, 60, 60, 1, c) for i, c in texts.items()],
                                  "id long, enable boolean, frequency int, throttle int, threshold int, condition string")
    ticks = alarms.match_ticks(hits, rules, "2024-01-01 00:00:00", 60)
    assert {(r.rule_id, r.matches) for r in ticks.where("tick = 1704067200").collect()} == {(1, 1), (2, 1), (3, 3), (4, 1)}
    assert sorted(r.id for r in alarms.bad_rules(rules).collect()) == [5, 6, 7, 8, 9]
    assert alarms.match(hits, rules.limit(0), "2024-01-01 00:00:00").count() == 0
    with pytest.raises(ValueError):
        conditions.predicate(texts[7])


def test_rules_of_ranges_meet_only_hits_of_their_cells(spark):
    import datetime as dt
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    hits = spark.createDataFrame([("a", "COST", f"t{d}", "1", "k", "/x", d, at) for d in (-5, 0, 1, 7, 8, 1000, 1024, 5_000_000, None)] + [
        ("b c=d", "ERROR", "t", "1", "k", "/x", 1000, at)],
        "app string, type string, trace_id string, span_id string, row_key string, span_name string, duration long, create_time timestamp")
    conditions_of = {
        1: '{"range":{"span.duration":{"gte":7,"lt":1024}}}', 2: '{"range":{"span.duration":{"gt":1000}}},{"term":{"type":"COST"}}', 3: '{"range":{"span.duration":{"lte":0}}}',
        4: '{"term":{"type":"ERROR"}}', 5: '{"term":{"app":"b c=d"}}', 6: '{"range":{"createTime":{"gte":"2023-01-01"}}}', 7: '{"range":{"span.duration":{"gte":9,"lt":3}}}'}
    rules = spark.createDataFrame([(i, True, 60, 60, 1, c) for i, c in conditions_of.items()],
                                  "id long, enable boolean, frequency int, throttle int, threshold int, condition string")
    got = sorted((r.rule_id, r.duration) for r in alarms.matching(hits, rules).collect() if r.duration is not None)
    every = [-5, 0, 1, 7, 8, 1000, 1000, 1024, 5_000_000]
    assert got == sorted([*((1, d) for d in (7, 8, 1000, 1000)), *((2, d) for d in (1024, 5_000_000)), (3, -5), (3, 0), (4, 1000), (5, 1000), *((6, d) for d in every)])
    assert alarms.matching(hits, rules.limit(0)).count() == 0
