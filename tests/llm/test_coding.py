"""Numpy parts without Spark: Simple-8b, units, SentencePiece segmentation, fuzzy words."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tracewell.llm import simple8b
from tracewell.llm.encoding import UnitEncoder, encode_texts
from tracewell.llm.fuzzy import Lexicon, allowed_edits
from tracewell.llm.pieces import Automaton, Pieces
from tracewell.llm.textbytes import SeenUnits, span_hashes, text_buffer

ODD = ["a", "B", "é", "É", "×", "÷", "ß", " ", "  ", "\n", "\t", "'s", "'", "’", "…", ".", ",", "1", "23", " ", "́", "中", "😀",
       "Σ", "ς", "İ", "-", "don't", "\r\n", "\x1c", "\x85", "▁", "                    ", "the", "≠"]


def odd_texts(seed: int, count: int = 3000) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 25))) for _ in range(count)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50_000) | st.integers(0, 1), max_size=400), st.integers(1, 130))
def test_simple8b_round_trip(ids, block):
    payload = simple8b.encode(np.array(ids, dtype=np.uint32), block)
    assert simple8b.decode(payload).tolist() == ids
    assert simple8b.decode(payload, 1, 3).tolist() == ids[block:3 * block]


def test_simple8b_packs_small_ids():
    assert len(simple8b.encode(np.zeros(60_000, dtype=np.uint32))) < 60_000 / 4
    with pytest.raises(ValueError):
        simple8b.decode(b"something else entirely")


@pytest.mark.parametrize("name,spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_units_give_the_library_ids(name, spaced):
    enc = UnitEncoder(public_tokenizers.path(name), spaced)
    texts = odd_texts(5)
    got = [x.tolist() for x in encode_texts(enc, *text_buffer(pa.array(texts)), 2)]
    want = [e.ids + [2] for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert got == want


def test_units_are_worked_out_once_and_forgotten_when_full():
    calls = []
    seen = SeenUnits(lambda units: calls.extend(units) or [[len(u)] * 2 for u in units], most=4)
    for text in ("a bb a", "ccc a", "dddd eeeee ffffff ggg a"):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        at = [i for i, w in zip(np.cumsum([0, *[len(w) + 1 for w in text.split()]]), text.split())]
        ends = np.array([a + len(w) for a, w in zip(at, text.split())])
        number = seen.numbers(data, np.array(at), ends)
        assert seen.gather(number).tolist() == [n for w in text.split() for n in (len(w), len(w))]
    assert calls.count(b"bb") == 1


def test_hashes_depend_on_bytes_only():
    data = np.frombuffer("xabcabc ab".encode(), dtype=np.uint8)
    h = span_hashes(data, np.array([1, 4, 8, 0]), np.array([4, 7, 10, 1]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3


def test_pieces_equal_the_library_and_come_back():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = odd_texts(6)
    ids, counts = model.encode(*text_buffer(pa.array(texts)))
    ends = np.cumsum(counts)
    got = [ids[e - n:e].tolist() for e, n in zip(ends, counts)]
    assert got == library.encode(texts)
    assert all(model.decode(np.array(x, dtype=np.int64)).decode() == t.replace("▁", " ") for x, t in zip(got, texts))


def test_viterbi_finds_the_best_sum():
    rng = random.Random(2)
    for _ in range(200):
        vocabulary = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): float(rng.randint(-9, -1)) for _ in range(6)}
        automaton = Automaton([(i, t, s) for i, (t, s) in enumerate(vocabulary.items())])
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 9)))
        best = [0.0] + [-1e9] * len(text)
        for e in range(1, len(text) + 1):
            for b in range(max(0, e - 4), e):
                w = text[b:e]
                score = vocabulary.get(w, automaton.lowest if e - b == 1 else None)
                if score is not None:
                    best[e] = max(best[e], best[b] + score)
        last, size = automaton.segment(np.array([[ord(c) for c in text]]), np.array([len(text)]), None)
        at, total = len(text), 0.0
        while at:
            piece = last[0, at]
            total += automaton.lowest if piece < 0 else list(vocabulary.values())[piece]
            at -= size[0, at]
        assert total == best[-1]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_lexicon_equals_brute_force():
    rng = random.Random(3)
    terms = [("idiot", False), ("worthless", False), ("lowei", True), ("moronic", True), ("scum", False)]
    lexicon = Lexicon(terms)
    for _ in range(3000):
        text = rng.choice(terms)[0]
        word = list(text + rng.choice(["", "", "xyz", "s"]))
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(word) + 1)
            word[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "o", "xy"])
        word = "".join(word)
        want = []
        for n, (term, stem) in enumerate(terms):
            e = min(edits(term, word[:k]) for k in range(len(word) + 1)) if stem else edits(term, word)
            if e <= allowed_edits(len(term), stem):
                want.append((e, -len(term), n))
        assert lexicon.closest(word) == ((min(want)[2], min(want)[0]) if want else None), word


