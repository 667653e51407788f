import json

from pyspark.sql import functions as F

from tracewell.functions import expressions as E
from tracewell.operators import parse, spans as S


def envelope(app, message):
    return json.dumps({"appname": app, "@timestamp": "2024-01-01T00:00:00.000Z", "message": message})


def test_request_envelopes(spark):
    body = {"uri": "/a", "method": "GET", "httpCode": 500, "startTime": 5, "endTime": 9}
    rows = [
        envelope("app", json.dumps({**body, "outputParamMap": {"R": {"code": 7}, "V": None}})),
        envelope("", json.dumps({**body, "outputParamMap": {"R": json.dumps({"code": "x"})}})),
        envelope("b", json.dumps({**body, "outputParamMap": {"R": {"msg": 1}}})),
        envelope("c", "not json"), "not json",
    ]
    df = parse.request_logs(spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, value string"))
    got = {r.i: r for r in df.withColumn("code", parse.business_code()).collect()}
    assert (got[0].app, got[0].uri, got[0].http_code, got[0].cost_ms, got[0].code) == ("APP", "/a", 500, 4, "7")
    assert (got[1].app, got[1].code) == ("", "x")
    assert got[2].code is None
    assert (got[3].app, got[3].uri) == ("C", None)
    assert got[4].app is None


def span(**fields):
    return {"traceId": "t", "id": "1", "timestamp": 10, "duration": 2, **fields}


def test_span_arrays_strict_and_tolerant(spark):
    values = [
        json.dumps([span(id="1"), span(id="2")]),
        json.dumps([span(id="3"), span(id="4", timestamp="soon")]),
        "not json", None,
        json.dumps([None, span(id="5")]),
        json.dumps([span(id="6", traceId=" ")]),
    ]
    raw = spark.createDataFrame([(v,) for v in values], "value string")
    assert {r.span_id for r in parse.span_arrays(raw).collect()} == {"1", "2", "5", "6"}
    assert {r.span_id for r in parse.span_arrays_tolerant(raw).collect()} == {"1", "2", "3", "5"}
    assert sorted(r.reason for r in parse.quarantine(raw).collect()) == ["bad element", "not a JSON array", "null value"]


def test_access_and_dimension_lines(spark):
    lines = spark.createDataFrame([("1.1.1.1 - - [2010-05-04 12:34:23] rest",), ("short line",), ("a b c [bad bad]",)],
                                  "value string")
    assert [(r.ip, str(r.ts)) for r in parse.access_lines(lines).collect()] == [("1.1.1.1", "2010-05-04 12:34:23")]
    dims = spark.createDataFrame([("1.1.1.1-here",), ("a-b-c",), ("none",)], "value string")
    assert [(r.key, r.area) for r in parse.dimension_lines(dims).collect()] == [("1.1.1.1", "here")]


def test_keys_and_node_names(spark, make_spans):
    df = S.normalize(make_spans(
        dict(id="1", name="Update x", local="s", tags={"sql.query": "", "tracingtype": "db"}),
        dict(id="2", parent="1", kind="CLIENT", local="s", remote="r", tags={"http.path": "/p"}),
        dict(id="3", parent="1", local="s", tags={"http.path": " "})))
    got = {r.span_id: r for r in df.withColumn("node", E.topology_node(F.col("local_service"), F.col("name"))).collect()}
    assert (got["1"].node, got["1"].metric_kind, got["1"].node_name) == ("s|db:DB-WRITE", None, "Update x")
    assert (got["2"].node, got["2"].node_app, got["2"].node_name) == ("s|null:/p", "r", "CLIENT||/p")
    assert (got["3"].metric_kind, got["3"].name) == ("null", "/3")


def test_database_filters(make_spans):
    df = make_spans(dict(id="1", tags=None), dict(id="2", tags={"sql.query": "x"}), dict(id="3"))
    assert {r.span_id for r in S.without_database(df).collect()} == {"1", "3"}
    assert {r.span_id for r in S.without_database_strict(df).collect()} == {"3"}


def test_lateness_is_sixteen_minutes(make_spans):
    df = make_spans(dict(id="ok", at=0.001), dict(id="late", at=0))
    now = F.lit("2024-01-01 00:16:00").cast("timestamp")
    assert [r.span_id for r in S.not_late(df, now).collect()] == ["ok"]


def test_bridge_gives_a_message_per_trace_and_batch(make_spans):
    df = make_spans(*[dict(id=str(i)) for i in range(40)], dict(id="0", trace="u"))
    got = S.bridge(df, F.col("span_id").cast("int") % 3).collect()
    assert sum(r.spans for r in got) == 41 and sorted(r.part for r in got if r.trace_id == "t") == [0, 1, 2]
    assert {(r.trace_id, r.part, r.spans) for r in S.bridge(df).collect()} == {("t", 0, 40), ("u", 0, 1)}
    assert {s["id"] for r in got for s in json.loads(r.value) if r.trace_id == "t"} == {str(i) for i in range(40)}


def test_every_typed_field_is_checked(spark):
    good = '{"traceId":"t","id":"1","timestamp":1,"duration":2,"shared":true,"localEndpoint":{"port":1},"tags":{"a":"b"}}'
    spoiled = [good.replace("true", '"maybe"'), good.replace('"port":1', '"port":"x"'), good.replace('{"a":"b"}', '"oops"'),
               good.replace('{"port":1}', "7"), good.replace(":2", ':"soon"'), "5"]
    values = [f"[{good},null]", *[f"[{good},{bad}]" for bad in spoiled], "[]", None, "{}"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    assert {r.span_id for r in parse.span_arrays(df).collect()} == {"1"} and parse.span_arrays(df).count() == 1
    assert parse.span_arrays_tolerant(df).count() == 1 + len(spoiled)
    reasons = {r.i: r.reason for r in parse.quarantine(df).collect()}
    assert reasons == {**{i + 1: "bad element" for i in range(len(spoiled))}, len(spoiled) + 2: "null value", len(spoiled) + 3: "not a JSON array"}


def test_metric_names_split_back(spark):
    df = spark.createDataFrame([("a", "SERVER", "/x"), ("a", None, "/y")], "app string, kind string, uri string")
    name = E.span_metric_name(F.col("app"), F.col("kind"), F.col("uri"))
    app, kind, uri = E.metric_name_parts(F.col("n"))
    back = df.withColumn("n", name).select(app.alias("app"), kind.alias("kind"), uri.alias("uri"))
    assert back.collect() == df.collect()
    assert df.select(E.link_metric_name(F.col("app"), F.col("uri"))).first()[0] == "a||/x"
