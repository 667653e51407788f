import json

from tracewell.operators import spans as S, trees
from tracewell.session import stage


def forest(df):
    return trees.forest(trees.nodes(S.normalize(df)))


def test_two_roots_orphans_cycles_and_self_parents(make_spans):
    df = make_spans(
        dict(id="0"), dict(id="1", parent="0"), dict(id="2", parent="0"), dict(id="3", parent="1"),
        dict(id="4", parent="3"), dict(id="5", parent="4"), dict(id="6"),
        dict(id="o", parent="missing"), dict(id="c", parent="d"), dict(id="d", parent="c"), dict(id="s", parent="s"))
    got = {r.span_id: (r.root_id, r.depth, r.path) for r in trees.edges(forest(df)).collect()}
    assert set(got) == set("0123456")
    assert got["5"] == ("0", 4, "0>1>3>4>5") and got["6"] == ("6", 0, "6")


def test_shared_ids_duplicate_the_subtree(make_spans):
    df = make_spans(dict(id="1", local="a"), dict(id="2", parent="1", kind="CLIENT", local="a"),
                    dict(id="2", parent="1", kind="SERVER", local="b"), dict(id="3", parent="2", local="b"))
    assert sorted(r.path for r in trees.edges(forest(df)).collect()) == ["1", "1>2", "1>2", "1>2>3", "1>2>3"]


def test_templates_keep_the_first_of_equal_calls(make_spans):
    def trace(t, repeats):
        calls = [dict(trace=t, id=f"c{i}", parent="r", name="/x", local="b") for i in range(repeats)]
        return [dict(trace=t, id="r", name="/r", local="a"), *calls,
                dict(trace=t, id="k", parent="c0", name="/y", local="b"), dict(trace=t, id="z", parent="c9", name="/q")]
    rows = trees.templates(forest(make_spans(*trace("t", 1), *trace("u", 3))))
    assert sorted((r.trace_id, r.span_id) for r in rows.collect()) == [
        (t, s) for t in ("t", "u") for s in ("c0", "k", "r")]
    found = trees.distinct_templates(trees.signatures(rows)).collect()
    assert [(r.root, r.trees, r.size) for r in found] == [("a==/r", 2, 3)]
    kept = trees.coverage(rows).collect()
    assert [(r.trace_id, r.new_nodes) for r in kept] == [("t", 3)]


def test_metric_tree_cuts_below_silent_nodes(spark, make_spans):
    rows = trees.templates(forest(make_spans(
        dict(id="1", name="/r", local="a"), dict(id="2", parent="1", kind="SERVER", name="/x", local="a"),
        dict(id="3", parent="2", kind="SERVER", name="/y", local="a"),
        dict(id="4", parent="1", kind="CLIENT", name="/z", local="a"))))
    metrics = spark.createDataFrame([("a", None, "/r", 1), ("a", "SERVER", "/y", 1), ("a", "CLIENT", "/z", 2)],
                                    "app string, metric_kind string, name string, total long")
    tree = trees.metric_tree(rows, trees.distinct_templates(trees.signatures(rows)), metrics, "total")
    assert sorted((r.name, r.depth) for r in tree.collect()) == [("/r", 0), ("CLIENT||/z", 1)]
    doc = json.loads(trees.tree_json(tree).first().json)
    assert doc["pid"] == -1 and [c["name"] for c in doc["children"]] == ["CLIENT||/z"]
    assert doc["children"][0]["pid"] == doc["id"]
    assert [r.name for r in trees.child_rows(tree).collect()] == ["/z"]


def test_the_join_with_metrics_is_made_once(spark, make_spans, monkeypatch):
    made = []
    monkeypatch.setattr(trees, "stage", lambda df, label="stage": made.append(label) or stage(df, label))
    rows = trees.templates(forest(make_spans(
        dict(id="1", name="/r", local="a"), dict(id="2", parent="1", kind="SERVER", name="/x", local="a"))))
    metrics = spark.createDataFrame([("a", None, "/r", 1)], "app string, metric_kind string, name string, total long")
    tree = trees.metric_tree(rows, trees.distinct_templates(trees.signatures(rows)), metrics, "total")
    assert made[-1] == "valued" and [r.name for r in tree.collect()] == ["/r"]
    plan = tree._jdf.queryExecution().optimizedPlan().toString()
    assert "valued-" in str(tree.inputFiles()) and "root_ts" not in plan
