from pyspark.sql import functions as F

from tracewell.operators import topology as T
from tracewell.session import stage


def links(df, **options):
    got = T.trace_links(T.linked_calls(df, **options)).collect()
    return sorted((r.parent, r.child, r.call_count, r.error_count, r.cost) for r in got)


def node(service, name):
    return f"{service}|http:{name}"


def test_single_server_root(make_spans):
    assert links(make_spans(dict(id="1", kind="SERVER", local="a"))) == []
    assert links(make_spans(dict(id="1", kind="SERVER", local="a", remote="B"))) == [
        (node("b", "/1"), node("a", "/1"), 1, 0, 10.0)]


def test_shared_span_merges_into_the_server_side(make_spans):
    df = make_spans(dict(id="1", kind="CLIENT", local="a", tags={"error": "x", "tracingtype": "http"}, name="/c"),
                    dict(id="1", kind="SERVER", local="b", name="/s", duration=7))
    assert links(df) == [(node("a", "/s"), node("b", "/s"), 1, 1, 7.0)]


def test_client_with_children_defers_to_the_child(make_spans):
    df = make_spans(dict(id="1", kind="CLIENT", local="a", remote="b", tags={"error": "", "tracingtype": "http"}),
                    dict(id="2", parent="1", kind="SERVER", local="b"))
    assert links(df) == [(node("a", "/1"), node("b", "/2"), 1, 1, 10.0)]


def test_local_spans_between_calls_and_backfill(make_spans):
    df = make_spans(dict(id="1", kind="SERVER", local="a"), dict(id="2", parent="1", local="a"),
                    dict(id="3", parent="2", kind="CLIENT", local="x", remote="b", duration=4))
    assert links(df, style="service") == [("a", "x", 1, 0, 4.0), ("x", "b", 1, 0, 4.0)]


def test_messaging_needs_a_broker(make_spans):
    df = make_spans(dict(id="1", kind="PRODUCER", local="a", remote="kafka"),
                    dict(id="2", parent="1", kind="CONSUMER", local="b"),
                    dict(id="3", parent="1", kind="CONSUMER", local="c", remote="kafka"))
    assert [(p, c) for p, c, *_ in links(df, style="service")] == [("a", "kafka"), ("kafka", "c")]


def test_unknown_kind_counts_as_client_when_both_sides_are_known(make_spans):
    df = make_spans(dict(id="1", local="a", remote="b"), dict(id="2", parent="1", local="a"))
    assert links(df, style="service") == [("a", "b", 1, 0, 10.0)]


def test_orphans_go_with_their_children_but_grandchildren_stay(make_spans):
    df = make_spans(dict(id="1", kind="SERVER", local="a"), dict(id="o", parent="gone", kind="SERVER", local="b"),
                    dict(id="c", parent="o", kind="SERVER", local="c"), dict(id="g", parent="c", kind="SERVER", local="d"))
    assert {r.span_id for r in T.prune_orphans(df).collect()} == {"1", "g"}
    assert [(p, c) for p, c, *_ in links(df, style="service")] == [("a", "d")]


def test_repair_first_root_wins_and_cycles_vanish(make_spans):
    df = make_spans(dict(id="1", at=5), dict(id="0", at=1), dict(id="2", parent="2"),
                    dict(id="c", parent="d"), dict(id="d", parent="c"), dict(id="k", parent="1"))
    nodes = T.repair(T.merge_shared(df))
    got = {r.span_id: r.parent for r in nodes.collect()}
    assert got == {"0": None, "1": "0", "c": "d", "d": "c", "k": "1"}
    climbed = {r.span_id: len(r["rank"]) for r in T.climb(nodes).collect()}
    assert climbed == {"0": 1, "1": 2, "k": 3}


def test_trace_without_root_hangs_below_a_synthetic_one(make_spans):
    nodes = T.repair(T.merge_shared(make_spans(dict(id="a", parent="x"), dict(id="b", parent="a"))))
    assert {r.span_id: (r.root_id, r.parent) for r in nodes.collect()} == {"a": (None, None), "b": (None, "a")}


def test_deep_chain_finds_the_nearest_kind(make_spans):
    rows = [dict(id="0", kind="SERVER", local="a")] + [dict(id=str(i), parent=str(i - 1)) for i in range(1, 20)]
    climbed = {r.span_id: (r.anc, len(r["rank"])) for r in T.climb(T.repair(T.merge_shared(make_spans(*rows)))).collect()}
    assert climbed["19"] == ("0", 20) and climbed["0"] == (None, 1)


def test_merge_fills_the_remote_side(make_spans):
    df = make_spans(dict(id="1", kind="SERVER", local="s"), dict(id="1", kind="CLIENT", local=None),
                    dict(id="1", kind="CLIENT", local="late"), dict(id="2", local="n"), dict(id="2", kind="CLIENT", local="c"))
    got = {r.span_id: (r.copies, r.kind, r.local_service, r.remote_service) for r in T.merge_shared(df).collect()}
    assert got == {"1": (3, "SERVER", "s", "late"), "2": (2, "CLIENT", "c", None)}


def test_cost_follows_the_visit_order(make_spans):
    df = make_spans(dict(id="r", kind="SERVER", local="a", name="/r"), *[
        dict(id=i, parent="r", kind="CLIENT", local="a", remote="b", name="/x", duration=d, at=at)
        for i, d, at in (("1", 8, 3), ("2", 4, 1), ("3", 0, 2), ("4", 16, 9))])
    got = T.trace_links(T.linked_calls(df, style="service")).first()
    assert (got.call_count, got.cost, got.cost_true_mean) == (4, ((4 + 8) / 2 + 16) / 2, 28 / 3)


def test_rows_split_node_names(spark):
    df = spark.createDataFrame([("t", "a|http:/x", "b|db:db-read", 2, 1, 7.9), ("u", "a|http:/x", "b", 1, 0, 2.0)],
                               "trace_id string, parent string, child string, call_count long, error_count long, cost double")
    rows = T.topology_rows(df.withColumn("ts", F.lit("2024-01-01 00:00:10").cast("timestamp"))).collect()
    assert sorted((r.parent_app, r.parent_url, r.child_app, r.child_url, r.type, r["count"], r.cost, r.error_rate) for r in rows) == [
        ("a", "/x", "b", "/x", "http", 1, 2.0, 0.0), ("a", "/x", "b", "db-read", "http", 2, 7.0, 50.0)]


def test_links_that_differ_in_the_type_of_the_child_are_rows_of_their_own(spark):
    df = spark.createDataFrame([("t", "a|grpc:/x", "b|grpc:/x", 1, 0, 3.0), ("u", "a|grpc:/x", "b|null:/x", 2, 1, 5.0)],
                               "trace_id string, parent string, child string, call_count long, error_count long, cost double")
    rows = T.topology_rows(df.withColumn("ts", F.lit("2024-01-01 00:00:10").cast("timestamp"))).collect()
    assert sorted((r.child_app, r.child_url, r.type, r["count"], r.cost, r.errors) for r in rows) == [
        ("b", "/x", "grpc", 1, 3.0, 0), ("b", "/x", "grpc", 2, 5.0, 1)]


def test_places_order_nodes_as_their_paths_do(make_spans):
    import random
    draw = random.Random(5)
    rows = [dict(id="r", at=50, trace=t) for t in ("t", "u")] + [dict(id="late", at=60)]
    for t in ("t", "u"):
        ids = ["r"]
        for i in range(90):  # ties in time, siblings whose ids do not follow it, children before their parents
            ids.append(f"n{draw.randrange(10 ** 6)}")
            rows.append(dict(id=ids[-1], trace=t, parent=draw.choice(ids[-6:-1]), at=draw.randrange(4), kind=draw.choice([None, "SERVER"])))
    rows += [dict(id="c", parent="d"), dict(id="d", parent="c"), dict(id="e", parent="c")]
    nodes = stage(T.repair(T.merge_shared(make_spans(*rows))))
    paths = sorted(T.climb(nodes).collect(), key=lambda r: (r.trace_id, len(r["rank"]), [tuple(p) for p in r["rank"]]))
    places = sorted(T.ascend(nodes).collect(), key=lambda r: (r.trace_id, r.depth, r.place))
    assert len(places) == 183
    assert [(r.trace_id, r.span_id, r.anc, r.depth) for r in places] == [
        (r.trace_id, r.span_id, r.anc, len(r["rank"])) for r in paths]


def test_long_chain_keeps_a_few_numbers_per_node(spark):
    n = 5000
    chain = spark.range(n).selectExpr(
        "'t' AS trace_id", "cast(id AS string) AS span_id", "cast(nullif(id - 1, -1) AS string) AS parent",
        "if(id % 1000 = 0, 'SERVER', null) AS kind", "timestamp_seconds(id) AS first_ts")
    got = T.ascend(chain)
    assert "rank" not in got.columns
    wrong = got.where("depth <> cast(span_id AS int) + 1 OR NOT anc <=> "
                      "if(span_id = '0', null, cast(int((cast(span_id AS int) - 1) / 1000) * 1000 AS string))")
    assert got.count() == n and wrong.isEmpty()


def test_no_nodes_have_no_places(make_spans):
    nodes = T.repair(T.merge_shared(make_spans(dict(id="1", kind="SERVER", local="a")))).where("false")
    assert T.ascend(nodes).isEmpty()
