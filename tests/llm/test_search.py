"""Hard negatives, the n-gram join and vector codes against brute force, on odd rows and crafted sets."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from corpus_fixtures import no_docs, odd_docs, prose  # noqa: F401
from test_operators import near_brute, texts_of
from tracewell.llm import hard_negatives as H, ngram_join as J, vector_codes as V
from tracewell.llm.queries import QUERIES

VECTORS = "vec_id long, label int, embedding array<float>, error long, code string, anchor long, block long"


@pytest.fixture(scope="session")
def odd_vectors(spark):
    """Nulls everywhere, copies, ties, repeated ids, another length, and columns named like the operators' own."""
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 4)), rng.normal(0, 0.2, 32).tolist()) for i in range(260)]
    rows += [(i, 1, [0.125] * 32) for i in range(300, 340)] + [(300, 2, [0.125] * 32), (300, 1, [0.125] * 32)]
    rows += [(400, None, rows[0][2]), (401, 1, None), (402, 1, [None] * 32), (403, 1, [float("nan")] + [0.0] * 31), (404, 1, [float("inf")] + [0.0] * 31),
             (405, 1, []), (406, 2, [0.5] * 16), (None, 1, rows[1][2]), (500, 9, [-0.3] * 32)]
    return spark.createDataFrame([r + (0, "x", 0, 0) for r in rows], VECTORS).repartition(3)


def kept_rows(vectors, need_label: bool) -> list[tuple]:
    got = [(r["vec_id"], r["label"], r["embedding"]) for r in vectors.collect()]
    whole = [(i, y, np.floor(256 * np.array(x, dtype=np.float32).astype(float)).astype(int)) for i, y, x in got
             if x and all(c is not None and math.isfinite(c) for c in x) and len(x) == 32]
    return [r for r in whole if r[0] is not None and r[1] is not None] if need_label else whole


def negatives_brute(rows: list[tuple], every: int) -> list[tuple]:
    out = []
    for a, (aid, label, v) in enumerate(rows):
        if aid % every:
            continue
        scored = sorted(((-int(v @ w), i, k) for k, (i, _, w) in enumerate(rows) if k != a))
        for minus, pid, _ in [x for x in scored if rows[x[2]][1] == label][:5]:
            fits = [x for x in scored if rows[x[2]][1] != label and -30 * minus <= -100 * x[0] <= -90 * minus][:10]
            out += [(aid, pid, k + 1, x[1], -minus, -x[0]) for k, x in enumerate(fits)]
    return sorted(out)


def test_hard_negatives(spark, odd_vectors):
    got = H.hard_negatives(odd_vectors, F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = negatives_brute(kept_rows(odd_vectors, True), 20)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200
    assert H.hard_negatives(odd_vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_hard_negatives_over_many_blocks(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16)
    monkeypatch.setattr(H, "ANCHORS", 3)
    monkeypatch.setattr(H, "PAGE", 4)
    given = odd_vectors.where("vec_id IS NULL OR vec_id != 300")
    got = H.hard_negatives(given.withColumn("label", F.col("label").cast("long")), F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == negatives_brute(kept_rows(given, True), 20)


def test_hilbert_curve_visits_neighbours():
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = np.argsort(np.array(H.hilbert_keys(points, 3), dtype=object), kind="stable")
    assert (np.abs(np.diff(points[order], axis=0)).sum(axis=1) == 1).all()


def test_score_bounds():
    rng = np.random.default_rng(3)
    block, anchors = rng.integers(-90, 90, (40, 24)), rng.integers(-90, 90, (7, 24))
    low, high = H.score_bounds(anchors, block.min(axis=0)[None], block.max(axis=0)[None])
    scores = anchors @ block.T
    assert (low[:, 0] <= scores.min(axis=1)).all() and (high[:, 0] >= scores.max(axis=1)).all()
    point_low, point_high = H.score_bounds(anchors, block, block)
    assert (point_low == scores).all() and (point_high == scores).all()


# --- n-gram join

def test_divide_skip_equals_counting():
    rng = np.random.default_rng(11)
    for _ in range(300):
        base = rng.choice(400, rng.integers(1, 60), replace=False)
        sets = []
        for _ in range(rng.integers(0, 12)):
            kept = base[rng.random(len(base)) < rng.choice([0.8, 0.9, 1.0])]
            sets.append(np.unique(np.concatenate([kept, rng.choice(400, rng.integers(0, 8))])).astype(np.uint64))
        query = np.unique(base).astype(np.uint64)
        want = [i for i, s in enumerate(sets) if len(s) and 100 * len(np.intersect1d(s, query)) >= 80 * len(np.union1d(s, query))]
        assert J.divide_skip(query, sets).tolist() == want
    assert J.divide_skip(np.zeros(0, dtype=np.uint64), [np.zeros(0, dtype=np.uint64)]).tolist() == []


def joined(docs, **sizes) -> dict:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in J.jaccard_join(docs, **sizes).collect()}


@pytest.mark.parametrize("shingle", [5, 1])
def test_join_of_odd_rows(odd_docs, no_docs, shingle):
    given = odd_docs.where("doc_id IS NOT NULL")
    want, sizes = near_brute(texts_of(given.select("doc_id", "text")), shingle)
    assert joined(given, shingle=shingle) == {i: (sizes[i], want[i]) for i in want}
    assert J.jaccard_join(odd_docs).count() == odd_docs.count()
    assert J.jaccard_join(no_docs).count() == 0


def test_join_of_families_and_passages(spark):
    """Chains of edits, a passage that all documents share, texts made of little else, short texts that differ by a word, and a large group of near copies."""
    rng = random.Random(4)
    passage = prose(1, 120)
    texts = []
    for k in range(40):
        words = prose(100 + k, 90).split()
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10 ** 6)}"
            texts.append(" ".join(words[:45]) + " " + passage + " " + " ".join(words[45:]))
            texts.append(" ".join(words))
    texts += [passage + " " + prose(500 + k, rng.randint(1, 12)) for k in range(40)]
    large = prose(9, 300).split()
    for k in range(150):
        words = list(large)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(300)] = f"n{rng.randrange(10 ** 6)}"
        texts.append(" ".join(words))
    texts += ["one two three", "One  two three", "one two", "a b c d e", "a b c d e f", "", None, " "]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    want, sizes = near_brute(rows, 5)
    assert joined(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == {i: (sizes[i], want[i]) for i in want}


def test_join_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, sizes = near_brute(texts_of(docs.select("doc_id", "text")), 5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op12_ngram_join"](spark, SMALL).collect()}
    assert got == {i: (sizes[i], want[i]) for i in want}


# --- vector codes

def codes_brute(rows: list[tuple], parts: int, entries: int, rounds: int):
    width = 32 // parts
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))[:entries]
    books = [np.array([r[2][p * width:(p + 1) * width] for r in order]) for p in range(parts)]

    def assign():
        return [[min((int(((r[2][p * width:(p + 1) * width] - e) ** 2).sum()), k) for k, e in enumerate(books[p])) for p in range(parts)] for r in rows]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(order)):
                mine = [r[2][p * width:(p + 1) * width] for r, f in zip(rows, found) if f[p][1] == k]
                if mine:
                    books[p][k] = np.sum(mine, axis=0) // len(mine)
    return assign(), books


@pytest.mark.parametrize("parts, entries", [(16, 64), (4, 7), (32, 3), (1, 200)])
def test_vector_codes(odd_vectors, parts, entries):
    rows = kept_rows(odd_vectors, False)
    coded, books = V.compress(odd_vectors, parts, entries)
    assert coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    found, want = codes_brute(rows, parts, entries, 2)
    assert (books.entries == np.array(want)).all()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {y: sum(e for e, r in zip(errors, rows) if r[1] == y) for _, y, _ in rows}
    expect = sorted((repr(r[0]), bytes(k for _, k in f), e, by_label[r[1]]) for r, f, e in zip(rows, found, errors))
    assert sorted((repr(r["vec_id"]), bytes(r["code"]), r["error"], r["label_error"]) for r in coded.collect()) == expect


def test_decoding(spark, odd_vectors):
    given = V.usable(odd_vectors)
    coded, books = V.compress(odd_vectors, 16, 64)
    back = {r["vec_id"]: np.array(r["values"]) for r in V.decode(coded.where("vec_id < 260"), books).collect()}
    for r in V.encode(given.where("vec_id < 260"), books).collect():
        row = next(v for i, _, v in kept_rows(given.where(F.col("vec_id") == r["vec_id"]), False)) if r["vec_id"] in (0, 7) else None
        if row is not None:
            assert int(((back[r["vec_id"]] - row) ** 2).sum()) == r["error"]


def test_codes_of_nothing(odd_vectors):
    coded, books = V.compress(odd_vectors.limit(0))
    assert coded.count() == 0 and books.entries.shape[1] == 0


def test_memo_keeps_results_when_it_starts_anew():
    rng = np.random.default_rng(2)
    book, parts = rng.integers(-200, 200, (64, 4)), rng.integers(-300, 300, (5000, 4))
    want = ((parts[:, None] - book[None]) ** 2).sum(axis=2)
    for most in (1, 50, 1 << 18):
        memo = V.CellMemo(book, most)
        for a in range(0, 5000, 700):
            index, distance = memo.nearest(parts[a:a + 700])
            assert (index == want[a:a + 700].argmin(axis=1)).all() and (distance == want[a:a + 700].min(axis=1)).all()


def test_codes_refuse_what_cannot_be_cut(odd_vectors):
    with pytest.raises(ValueError):
        V.compress(odd_vectors, 5)
