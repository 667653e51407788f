"""The pipeline's stages, each against what its operator says of its input."""

import corpus_pipeline
from check import engine
from conftest import SMALL
from test_operators import near_brute, texts_of

from tracewell.llm import exact_dups, toxicity
from tracewell.session import stage


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen, results = docs, []
    for name, fn in corpus_pipeline.STAGES:
        out = stage(fn(spark, seen, SMALL), f"test-{name}")
        results.append((name, seen, out))
        seen = out
    assert [name for name, *_ in results] == ["toxicity", "language", "exact", "near", "pack"]
    assert all(out.columns == docs.columns for _, _, out in results[:-1])
    inputs = {name: before for name, before, _ in results}
    kept = {name: {r["doc_id"] for r in out.select("doc_id").distinct().collect()} for name, _, out in results}
    model = toxicity.fit(toxicity.labelled_texts(docs, spark.read.parquet(f"{SMALL}/labels.parquet")))
    assert kept["toxicity"] == {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 0").collect()}
    assert kept["exact"] == {r["doc_id"] for r in exact_dups.exact_duplicates(inputs["exact"]).where("kept").collect()}
    want, _ = near_brute(texts_of(inputs["near"].select("doc_id", "text")), 5)
    assert kept["near"] == set(want.values())
    assert kept["pack"] == kept["near"]
    # texts are passed on whole
    given = dict(engine(SMALL).execute("SELECT doc_id, text FROM documents").fetchall())
    assert all(given[i] == t for i, t in texts_of(results[3][2].select("doc_id", "text")))
