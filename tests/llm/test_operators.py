"""Operators on Spark against brute force, on odd rows and on the small tables."""

import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from check import compare, engine
from conftest import SMALL
from test_coding import edits
from corpus_fixtures import no_docs, odd_docs, prose  # noqa: F401
from tracewell.llm import chat, exact_dups, fingerprints, language, line_dups, near_dups, packing, pieces, token_files, toxicity
from tracewell.llm.components import bucket_links, components
from tracewell.llm.queries import ORACLES, QUERIES, table
from tracewell.session import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def texts_of(docs) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL).toPandas(), engine(SMALL).execute(ORACLES[name]).df()) == ""


# --- token files

def test_token_files(spark, odd_docs):
    from tokenizers import Tokenizer
    path, model = new_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(odd_docs, path, model, 2)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    library = Tokenizer.from_file(model)
    want = sorted((np.array(library.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4").tobytes() for _, t in texts_of(odd_docs)))
    assert sorted(bytes(r["ids"]) for r in got) == want
    assert [r["doc_id"] for r in got] == sorted((r["doc_id"] for r in got), key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in got] == (np.cumsum([r["n_tokens"] for r in got]) - [r["n_tokens"] for r in got]).tolist()
    assert all(4 * r["n_tokens"] == len(r["ids"]) for r in got)


def test_token_files_of_nothing(spark, no_docs):
    path = new_path(spark, "tokens")
    token_files.write_token_files(no_docs, path, public_tokenizers.path("word_bpe_49k.json"), 2)
    assert token_files.read_token_files(spark, path).count() == 0


# --- language

def test_language_held_out(spark):
    got = QUERIES["op2_language"](spark, SMALL.replace("0.001", "0.01")).join(table(spark, SMALL.replace("0.001", "0.01"), "documents"), "doc_id")
    rows = got.where("held_out").select("lang", "lang_pred", "score").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_fit_keeps_dense_rows_out_of_the_driver(spark):
    docs = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    tracemalloc.start()
    model = language.fit(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.languages) == 4 and peak < 80e6


def test_language_kernel_counts_common_sequences():
    rng = np.random.default_rng(3)
    bits = rng.random((7, language.TOTAL)) < 0.01
    bits[6] = False
    want = np.zeros((7, 3))
    for n, size in language.SIZES.items():
        part = bits[:, language.OFFSETS[n]:language.OFFSETS[n] + size].astype(float)
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1))
        want += part @ part[:3].T
    packed = np.packbits(bits, axis=1)
    assert np.allclose(language._kernel(packed, packed[:3]), want, atol=1e-5)


def test_language_odd_rows(spark, odd_docs, no_docs):
    model = language.fit(table(spark, SMALL, "documents"))
    got = {r["doc_id"]: r for r in language.predict(odd_docs, model).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3, 11}
    assert got[6]["lang_pred"] == got[13]["lang_pred"] and got[6]["score"] == got[13]["score"]
    assert language.predict(no_docs, model).count() == 0
    kept = {r["doc_id"] for r in language.drop_unknown(odd_docs, model).collect()}
    assert not kept & {1, 2, 3, 11} and language.drop_unknown(odd_docs, model).columns == odd_docs.columns
    blind = language.fit(no_docs)
    assert {r["lang_pred"] for r in language.predict(odd_docs, blind).collect()} == {"und"}


# --- chat

def test_chat(spark):
    rows = [(1, 0, "user", "a <| b <\\| c"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nx"), (2, 0, "assistant", "early"), (2, 1, "user", None),
            (3, 0, None, "t"), (3, 0, "we%ird\nrole<|", ""), (4, 5, "user", "x"), (4, 5, "user", "x"), (None, 0, "user", "n"), (5, None, "system", "s"),
            (5, 0, "user", "u"), (5, 1, "assistant", "v")]
    turns = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, position int")
    formatted = chat.format_turns(turns)
    parsed = chat.parse_turns(formatted)
    got = sorted(((r["conv_id"], r["role"], r["text"]) for r in parsed.collect()), key=repr)
    assert got == sorted(((c, role or "", text or "") for c, _, role, text in rows), key=repr)
    assert all(r["learned"] == (r["text"] if r["role"] == "assistant" else "") for r in parsed.collect())
    flat = "".join(s["text"] for r in formatted.where("conv_id = 1").orderBy("position").collect() for s in r["segments"])
    assert flat.count("<|im_start|>") == flat.count("<|im_end|>") == 2
    states = {r["conv_id"]: (r["turns"], r["valid"]) for r in chat.conversation_states(formatted).collect()}
    assert states[1] == (2, True) and states[5] == (3, True) and not any(states[c][1] for c in (2, 3, 4))
    assert chat.conversation_digests(chat.parse_turns(chat.format_turns(turns.limit(0)))).count() == 0


# --- exact duplicates

def test_exact(spark, odd_docs, no_docs):
    got = exact_dups.exact_duplicates(odd_docs).collect()
    same = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups: dict = {}
    for i, t in texts_of(odd_docs):
        groups.setdefault(hashlib.sha256(same(t).encode()).hexdigest(), []).append(i)
    assert len(got) == odd_docs.count()
    for r in got:
        ids = [i for i in groups[r["text_sha256"]] if i is not None]
        assert r["keep_id"] == min(ids, default=None) and r["group_size"] == len(groups[r["text_sha256"]])
    assert sum(r["kept"] for r in got) == len(groups)
    left = exact_dups.drop_exact_duplicates(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == len(groups)
    assert exact_dups.exact_duplicates(no_docs).count() == 0


# --- near duplicates

def near_brute(texts: list[tuple], shingle: int, similar: int = 80) -> tuple[dict, dict]:
    sets = {}
    for i, t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + shingle]) for k in range(max(len(w) - shingle + 1, 1))} if w else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = [i for i in sets if i is not None and sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if 100 * len(sets[a] & sets[b]) >= similar * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("shingle", [2, 5])
def test_near(spark, odd_docs, shingle):
    want, sizes = near_brute(texts_of(odd_docs), shingle)
    got = near_dups.near_duplicates(odd_docs, shingle).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], sizes[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_near_table_and_chain(spark):
    docs = table(spark, SMALL, "documents").select("doc_id", "text")
    # a chain: each text shares most with the next, the ends share little
    words = [f"w{k}" for k in range(260)]
    chain = spark.createDataFrame([(10_000 + k, " ".join(words[8 * k:8 * k + 100])) for k in range(20)], "doc_id long, text string")
    both = docs.unionByName(chain)
    want, _ = near_brute(texts_of(both), 2)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(both, 2).collect()}
    assert got == want and got[10_019] == 10_000


def test_drop_near(spark, odd_docs, no_docs):
    left = near_dups.drop_near_duplicates(odd_docs)
    want, _ = near_brute(texts_of(odd_docs), 5)
    assert left.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in left.where("doc_id IS NOT NULL").collect()) == sorted({v for v in want.values() if v is not None})
    assert near_dups.near_duplicates(no_docs).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(60, 90)] + [(5, 5), (3, 2), (2, 3), (None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 60 for k in [*range(60, 90), 100]}}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_bucket_links_tests_every_pair(spark):
    # two buckets of unlike nodes, with a few links that hardly any centre meets
    members = spark.range(2300).selectExpr("explode(array(1L, 2L)) AS bucket", "2300L AS size", "id AS node", "100 + id % 3 AS n")
    confirm = lambda pairs: pairs.where("a = b + 3 AND a % 100 = 7 OR a = 2299 AND b = 2")
    links, found = bucket_links(members, confirm, "n = m OR n + m = 203")
    want = {(a, a - 3) for a in range(7, 2300, 100)} | {(2299, 2)}
    assert {(r["a"], r["b"]) for r in links.collect()} == want
    assert {r["node"]: r["component"] for r in found.collect()} == {x: b for a, b in want for x in (a, b)}


def test_near_in_a_family(spark):
    # texts of one template at resemblance 0.6, a few real near copies among them
    rng, frame = random.Random(11), prose(21, 120).split()
    texts = []
    for k in range(400):
        own = frame.copy()
        own[70:100] = prose(1000 + k, 30).split()
        texts.append(own)
    for k in range(0, 400, 40):
        texts.append(texts[k].copy())
        texts[-1][rng.randrange(70, 100)] = "changed"
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want, _ = near_brute(rows, 2)
    got = {r["doc_id"]: r["component_id"] for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == want and sum(i != c for i, c in got.items()) == 10


def test_sketch_differs_no_more_than_the_sets():
    rng = np.random.default_rng(3)
    for size in (1, 30, 3000):
        a, b = (rng.integers(0, 1 << 63, size, dtype=np.uint64) for _ in range(2))
        b[:size // 2] = a[:size // 2]
        bits = sum(bin(int(x) & 0xFFFFFFFFFFFFFFFF).count("1") for x in near_dups.sketch(a) ^ near_dups.sketch(b))
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))


# --- fingerprints

def shingles(text: str) -> set:
    w = text.split()
    return {tuple(w[a:a + 5]) for a in range(max(len(w) - 4, 1))} if w else set()


def test_fingerprints(spark, odd_docs, no_docs):
    unique = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    bounds = token_files.id_bounds(unique.select("doc_id"), "doc_id", 4)
    got = {r["doc_id"]: r for r in fingerprints.compare_edited(unique, bounds).collect()}
    order = sorted((i, t or "") for i, t in texts_of(unique))
    for k, (i, t) in enumerate(order):
        cut, following = len(t) // 4, order[(k + 1) % len(order)][1]
        edited = t[:len(t) - cut] + following[:cut]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        for other, name in ((edited, "near_edited"), (following, "near_next")):
            a, b = shingles(t), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert abs(got[i][name] - true) < 0.2, (i, name, got[i][name], true)
    assert got[6]["fingerprint"] == got[13]["fingerprint"] != got[8]["fingerprint"] and got[2]["fingerprint"] == ""
    assert fingerprints.compare_edited(no_docs, []).count() == 0


# --- packing

def check_pieces(rows, ids: dict, window: int = 2048) -> int:
    """Checks that all ids lie in one piece each and sequences are gapless; returns the padding."""
    by_doc: dict = {}
    by_sequence: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc, want in ids.items():
        mine = sorted(by_doc[doc], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == want and all(4 * r["doc_tokens"] == len(want) for r in mine)
        assert [r["start"] for r in mine] == np.cumsum([0, *[r["length"] for r in mine[:-1]]]).tolist()
    padding = 0
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end and length > 0
            end += length
        assert end <= window
        padding += 0 if end & (end - 1) == 0 else window - end
    return padding


def test_packing(spark, odd_docs, no_docs):
    from tokenizers import Tokenizer
    model = public_tokenizers.path("byte_bpe_50k.json")
    unique = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    library = Tokenizer.from_file(model)
    for docs in (unique, table(spark, SMALL, "documents")):
        ids = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4").tobytes() for i, t in texts_of(docs)}
        assert check_pieces(packing.pack(docs, model, 1).collect(), ids) == 0
    whole = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts_of(odd_docs))
    assert packing.pack(odd_docs, model, 1).agg(F.sum("length")).first()[0] == whole
    assert packing.pack(no_docs, model, 1).count() == 0


def test_drawn_combinations_favour_no_length():
    found = [c for c in packing.combinations(np.where(np.arange(2048) > 0, 10, 0), 2048) if len(c) == 3]
    assert max(min(c) for c in found) > 500


def test_plan_places_most_remainders_whole():
    rng = np.random.default_rng(5)
    counts = np.bincount(np.clip(rng.lognormal(6, 0.9, 40_000).astype(int), 1, 2047), minlength=2048)
    plan = packing.Plan(counts, 7)
    assert plan.uncut > 0.9 * counts.sum()
    lengths = np.repeat(np.arange(2048), counts)
    ranks = np.concatenate([np.arange(c) for c in counts])
    sequence, offset, streamed = plan.places(lengths, ranks)
    whole = streamed < 0
    assert whole.sum() == plan.uncut
    filled = np.bincount(sequence[whole], weights=lengths[whole])
    assert set(filled[7:].tolist()) == {2048.0} and not filled[:7].any()


# --- fuzzy lines

def test_word_edits():
    rng = random.Random(7)
    for _ in range(2000):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert line_dups.word_edits(a, b) == edits("".join(a), "".join(b))


def test_many_edits_are_those_of_each_pair():
    rng = random.Random(9)
    left = ["".join(rng.choice("abc \u4e00") for _ in range(rng.choice([0, 1, 5, 63, 64, 65, 128, 200]))) for _ in range(300)]
    right = ["".join(rng.choice("abcd") if rng.random() < 0.2 else c for c in x[rng.randint(0, 3):]) + "b" * rng.randint(0, 70) for x in left]
    assert line_dups.many_edits(left, right).tolist() == [line_dups.word_edits(a, b) for a, b in zip(left, right)]
    least = line_dups.least_edits(left, right)
    assert (least <= line_dups.many_edits(left, right)).all() and line_dups.least_edits(["abcdef", ""], ["uvwxyz", "a"]).tolist() == [6, 0.5]
    wide = ["".join(chr(0x4E00 + rng.randrange(9000)) for _ in range(900)) for _ in range(20)]
    assert line_dups.many_edits(wide, wide[1:] + wide[:1]).tolist() == [line_dups.word_edits(a, b) for a, b in zip(wide, wide[1:] + wide[:1])]


def test_many_edits_up_to_a_bound():
    """Same verdict as the whole tables, over bands of one word and of several, near and far, beside pairs that end early."""
    rng = random.Random(11)
    left = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([5, 60, 64, 65, 130, 400, 420, 430, 700]))) for _ in range(2000)]
    rates = [rng.choice([0, 0.05, 0.15, 0.2, 0.25, 0.5, 1]) for _ in left]
    right = ["".join(rng.choice(["", "x", c + "a"]) if rng.random() < rate else c for c in x) for x, rate in zip(left, rates)]
    most = 0.2 * np.array([max(len(a), len(b)) for a, b in zip(left, right)]) + 1e-9
    exact = np.array([line_dups.word_edits(a, b) for a, b in zip(left, right)])
    got = line_dups.many_edits(left, right, most)
    assert 500 < (exact <= most).sum() < 1500 and ((got <= most) == (exact <= most)).all() and (got[exact <= most] == exact[exact <= most]).all()


def test_lines(spark, no_docs):
    rule = "This long line of boilerplate text stands in very many of the documents here, with number %d at its end"
    texts = ["first line\n" + rule % 7, rule % 8 + "\nown words\n\n\nown words", None, "", "OWN   words!", "short", "short",
             rule.replace("boilerplate", "boilerplates") % 9, "\n".join(f"row {k} alpha beta gamma {'x' * k}" for k in range(30))]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, line int")
    got = {r["doc_id"]: (r["n_lines"], r["dropped"]) for r in line_dups.repeated_lines(docs).collect()}
    assert got[0] == (2, []) and got[2] == got[3] == (1, []) and got[4] == (1, [0]) and got[5] == (1, []) and got[6] == (1, [0])
    assert got[1] == (5, [0, 4]) and got[7] == (1, [0])
    cleaned = {r["doc_id"]: r["text"] for r in line_dups.drop_repeated_lines(docs).collect()}
    assert cleaned[1] == "own words\n\n" and cleaned[2] is None and cleaned[0] == texts[0]
    assert line_dups.repeated_lines(no_docs).count() == 0


def test_lines_odd_rows(spark, odd_docs):
    got = {r["doc_id"]: r for r in line_dups.repeated_lines(odd_docs).collect()}
    assert len(got) == odd_docs.select("doc_id").distinct().count()
    assert got[5]["dropped"] == [0] and got[13]["dropped"] == [0] and got[8]["dropped"] == [0] and got[12]["n_kept"] == 1


def dropped_of(spark, texts: list) -> list:
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r["dropped"] for r in line_dups.repeated_lines(docs).orderBy("doc_id").collect()]


def test_lines_are_compared_by_letters(spark):
    # two of six words differ, but two of 39 letters; the long word decides the SimHash
    line = "alphabet alphabet alphabet alphabet a b"
    assert dropped_of(spark, [line, line.replace("a b", "c d"), "alphabet alphabet alphabet alphabet and others behind"]) == [[], [0], []]


def test_lines_without_blanks(spark):
    line = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(200))
    address = "example" + "abcdefghijklmnopqrstuvwxyz" * 6
    texts = [line + "\n" + address, line[:120] + "\u3002" + line[121:], address + "x", "\u4e00" * 3 + line[::-1]]
    assert dropped_of(spark, texts) == [[], [0], [0], []]


def test_lines_find_nine_of_ten_like_lines(spark):
    """Every pair of different lines of a table against the groups found: letter bags rule out pairs without a loss, edits decide."""
    docs = table(spark, SMALL, "documents")
    place, first = {}, []
    for r in sorted(docs.select("doc_id", "text").collect(), key=lambda r: r["doc_id"]):
        for k, line in enumerate((r["text"] or "").encode().split(b"\n")):
            text = line_dups.normalised(line)
            if len(text) >= line_dups.LEAST and text not in place:
                place[text] = len(first)
                first.append((r["doc_id"], k))
    texts = sorted(place, key=len)
    bags = np.zeros((len(texts), 512), dtype=np.int32)
    for i, text in enumerate(texts):
        for k in range(len(text) - 1):
            bags[i, (ord(text[k]) * 31 + ord(text[k + 1])) % 512] += 1
    sizes = np.array([len(t) for t in texts])
    group = list(range(len(first)))

    def root(x: int) -> int:
        while group[x] != x:
            x = group[x]
        return x
    for i, text in enumerate(texts):
        last = np.searchsorted(sizes, sizes[i] / line_dups.SIMILAR + 1e-9, side="right")
        apart = np.abs(bags[i + 1:last] - bags[i]).sum(axis=1)
        for j in np.flatnonzero(apart <= 4 * (1 - line_dups.SIMILAR) * sizes[i + 1:last] + 1e-6) + i + 1:
            if line_dups.word_edits(text, texts[j]) <= (1 - line_dups.SIMILAR) * sizes[j] + 1e-9:
                a, b = sorted((root(place[text]), root(place[texts[j]])))
                group[b] = a
    want = {first[k] for k in range(len(first)) if root(k) != k}
    got = {r["doc_id"]: set(r["dropped"]) for r in line_dups.repeated_lines(docs).collect()}
    found = {p for p in first if p[1] in got[p[0]]}
    assert len(want) > 30 and found <= want and len(found) >= 0.9 * len(want)


def test_simhashes_count_votes():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 2, 700, 0, 255, 256, 3]
    hashes = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    line = np.repeat(np.arange(len(sizes)), sizes)
    got = line_dups.simhashes(hashes, line, len(sizes))
    for k in range(len(sizes)):
        own = [int(h) for h in hashes[line == k]]
        assert int(got[k]) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))


def test_short_lines_with_one_wrong_letter(spark):
    lines = [f"{prose(100 + k, 6)}" for k in range(40)]
    wrong = [line[:len(line) // 2] + "y" + line[len(line) // 2 + 1:] for line in lines]
    found = [d for d in dropped_of(spark, [x for pair in zip(lines, wrong) for x in pair])[1::2]]
    assert sum(d == [0] for d in found) >= 36


def test_lines_of_null_and_repeated_ids(spark):
    line = "a long line of boilerplate text that stands in many documents with the number %d at its end"
    rows = [(None, line % 1), (1, line % 1), (2, line % 2), (3, "quite another thing"), (3, "wonderful weather outside, said nobody at all today"),
            (4, "wonderful wezther outside, said nobody at all today")]
    # equal lines after folding digits are one node; the misspelled line differs by a letter
    rows += [(5, (line % 1).replace("boilerplate", "boilerplzte"))]
    got = {r["doc_id"]: r["dropped"] for r in line_dups.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[None] == [] and got[1] == got[2] == got[5] == [0] and got[3] == [] and got[4] == [0]


# --- toxicity

def test_toxicity(spark, odd_docs, no_docs):
    folder = SMALL.replace("0.001", "0.01")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(toxicity.labelled_texts(docs, labels))
    known = {r["doc_id"]: (r["score"], r["predicted"]) for r in toxicity.score(docs, model).collect()}
    held = [(r["toxic"], known[r["doc_id"]]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    toxic = [s for t, (s, _) in held if t == 1]
    clean = [s for t, (s, _) in held if t == 0]
    assert np.mean([[a > b or 0.5 * (a == b) for b in clean] for a in toxic]) > 0.8
    assert np.mean([s < toxicity.THRESHOLD for s in clean]) > 0.95
    odd = {r["doc_id"]: r for r in toxicity.score(odd_docs, model).collect()}
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in odd.values())
    assert odd[1]["score"] == odd[2]["score"] == odd[3]["score"]
    assert toxicity.score(no_docs, model).count() == 0
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not p for _, p in known.values())


def test_toxic_words_misspelled_and_quoted():
    model = toxicity.Model([("idiot", False), ("worthless", False), ("lowei", True)], {(t, e): 5.0 - 2 * e for t in range(3) for e in range(3)},
                           [-4.0, 1.0, 0.3, 0.1])
    found = toxicity.Matcher(model)
    import pyarrow as pa
    from tracewell.llm.textbytes import text_buffer
    texts = ["you IDIOT", "an 1diot and w0rthles", "he said the word idiot here", 'called "idiot" there', "loweischaft", "idyll", "", "clean words"]
    count, matches = found.matches(*text_buffer(pa.array(texts)))
    assert [len(m) for m in matches] == [1, 2, 1, 1, 1, 0, 0, 0] and count.tolist()[0] == 2
    assert [m[0][3] for m in matches[:5]] == ["address", "plain", "quotation", "quotation", "plain"]
    x = [toxicity.features(model, m) for m in matches]
    assert x[0][1] > x[4][1] > 0 and x[2][1] == 0 < x[2][2]


def test_density_counts_the_whole_text():
    model = toxicity.Model([("idiot", False)], {(0, 0): 1.0}, [-4.0, 1.0, 0.3, 0.1])
    scattered = [(100 * k, 0, 0, "plain", "idiot") for k in range(300)]
    run = [(40_000 + k, 0, 0, "plain", "idiot") for k in range(49)]
    assert toxicity.features(model, scattered)[3] == pytest.approx(np.log1p(1))
    assert toxicity.features(model, scattered + run)[3] == pytest.approx(np.log1p(49))
    assert toxicity.features(model, [])[3] == 0


def test_fitting_sees_every_match(spark):
    model = toxicity.Model([("idiot", False)], {(0, 0): 1.0}, [-4.0, 1.0, 0.3, 0.1])
    sample = spark.createDataFrame([("idiot " * 1500, 1)], "text string, label int")
    assert [len(r["matches"]) for r in toxicity._sample_matches(sample, model)] == [1500]


def test_toxicity_without_labels(spark, odd_docs):
    empty = spark.createDataFrame([], "text string, label int")
    assert {r["predicted"] for r in toxicity.score(odd_docs, toxicity.fit(empty)).collect()} == {0}


# --- pieces

def test_pieces_frames(spark, odd_docs, no_docs):
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = pieces.decode_pieces(pieces.encode_pieces(odd_docs, model), model).collect()
    assert sorted((r["text"] for r in back)) == sorted((t or "" for _, t in texts_of(odd_docs)))
    assert all(len(r["ids"]) == 4 * r["n_pieces"] for r in back)
    assert pieces.encode_pieces(no_docs, model).count() == 0
