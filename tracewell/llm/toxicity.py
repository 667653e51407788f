"""Toxicity by a learned lexicon, matched with Levenshtein automata, and scores of the context of each match.

Fitting takes a bounded sample of labelled texts, near copies left out: words and word beginnings that mark toxic texts
become the lexicon, each chosen for the toxic texts that those before it don't explain, the share of toxic texts gives each term and number of edits its weight, and a logistic model joins
the weights of a text's matches. A match in quotation marks or next to a reporting word counts as
quotation, one next to a word of direct address as abuse.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracewell.llm.fuzzy import Lexicon
from tracewell.llm.textbytes import LOWER, SeenUnits, chunks, text_buffer, words
from tracewell.session import stage

SAMPLE = {1: 6000, 0: 9000}   # labelled rows to fit on, by label
TERMS = 400                   # terms at most, those with most evidence
KINDRED = 0.15                # share of the chosen terms' median evidence that makes a term one of theirs
CANDIDATES = 1500             # terms tried, those with most evidence each by itself
EVIDENCE = 25.0               # likelihood ratio (G²) that a term must reach
RATIO = 6.0                  # times its share of clean texts that its share of toxic texts must reach
PREFIXES = range(3, 9)
AROUND = 6                    # words on each side that make a match's context
CLOSE = 50                    # words within which matches count as dense
THRESHOLD = 0.3

REPORTING = frozenset("said says word words term called quote quoted wrote insult slur sagte schrieb wort zitat dit mot "
                      "écrit citation dijo palabra escribió cita".split())
ADDRESS = frozenset("you your youre u du dich dir ihr euch tu toi te vous tú ti usted ustedes vosotros".split())
LEET = str.maketrans("013457@$", "oieastas")
OPENING, CLOSING = re.compile("[\"“„«‘]"), re.compile("[\"”“»’]")

INSIDE = np.zeros(256, dtype=bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), ord("@"), ord("$"), *range(128, 256)]] = True


def normal(raw: bytes) -> str:
    """A word as compared: lower case, look-alike digits and signs as letters, nothing else than letters."""
    word = raw.decode("utf-8", "replace").lower()
    if word.isalpha():
        return word
    if not any(c.isalpha() for c in word):
        return ""
    return "".join(c for c in word.translate(LEET) if c.isalpha())


@dataclass
class Model:
    """What fitting learns; without labels there are no terms and every score is 0."""

    terms: list[tuple[str, bool]] = field(default_factory=list)
    weights: dict[tuple[int, int], float] = field(default_factory=dict)
    coefficients: list[float] = field(default_factory=lambda: [-1e9, 0.0, 0.0, 0.0])


def sample_of(labelled: DataFrame, sizes: dict[int, int] = SAMPLE) -> DataFrame:
    """About ``sizes`` ids per label, chosen by a hash of the id: (doc_id, label)."""
    known = labelled.where("label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for label, size in sizes.items():
        share = F.when(F.col("label") == label, min(1.0, size / max(counts.get(label, 0), 1))).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) / 1e6
    return known.where(draw < share)


def unlike(sample: DataFrame) -> DataFrame:
    """(text, label) with one row of near copies: texts of one label that agree in the two smallest hashes of their long words.

    A text copied a thousand times says no more about its words than once.
    """
    long_words = F.filter(F.split(F.lower("text"), r"\s+"), lambda w: F.char_length(w) >= 8)
    smallest = F.slice(F.array_sort(F.array_distinct(F.transform(long_words, lambda w: F.xxhash64(w)))), 1, 2)
    sketch = F.when(F.size(smallest) == 2, F.xxhash64(smallest)).otherwise(F.xxhash64("text"))
    return sample.withColumn("sketch", sketch).groupBy("label", "sketch").agg(F.min("text").alias("text")).select("text", "label")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch, first and last row, bytes, offsets) of stretches of bounded size."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        for i, j in chunks(offsets):
            part, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            yield batch, i, j, part, at


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): in how many sample texts a word, or a word beginning, occurs."""
    def rows(batches):
        counts = {0: Counter(), 1: Counter()}
        total = Counter()
        for batch, i, j, part, at in _texts(batches):
            starts, ends, text = words(part, at, INSIDE)
            raw, labels = part.tobytes(), batch.column("label").to_pylist()[i:j]
            per_text: list[set] = [set() for _ in range(i, j)]
            for t, a, b in zip(text.tolist(), starts.tolist(), ends.tolist()):
                per_text[t].add(raw[a:b])
            for label, found in zip(labels, per_text):
                total[label] += 1
                whole = {normal(w) for w in found} - {""}
                counts[label].update((w, False) for w in whole)
                counts[label].update({(w[:k], True) for w in whole for k in PREFIXES if len(w) >= k})
        names = ["term", "stem", "toxic", "clean"]
        keys = list(set(counts[0]) | set(counts[1]))
        keys_all = keys + [("", False)]
        toxic = [counts[1][k] for k in keys] + [total[1]]
        clean = [counts[0][k] for k in keys] + [total[0]]
        for a in range(0, len(keys_all), 50_000):
            part = keys_all[a:a + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.bool_()),
                 pa.array(toxic[a:a + 50_000], pa.int64()), pa.array(clean[a:a + 50_000], pa.int64())], names)
    partial = sample.select("text", "label").mapInArrow(rows, "term string, stem boolean, toxic long, clean long")
    return partial.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def candidate_terms(found: list, most: int = CANDIDATES) -> list[tuple[str, bool]]:
    """From terms with evidence, those that say most: the longest beginning that loses hardly a text, whole words where a
    beginning is always one word."""
    stems = {r["term"]: r["toxic"] for r in found if r["stem"]}
    whole = {r["term"]: r["toxic"] for r in found if not r["stem"]}
    evidence = {(r["term"], r["stem"]): r["evidence"] for r in found}
    chosen: dict[tuple[str, bool], float] = {}
    for term in stems:
        best = term
        while True:  # go on while one longer beginning has nearly all of the texts
            longer = [s for s in stems if len(s) == len(best) + 1 and s.startswith(best) and stems[s] >= 0.95 * stems[term]]
            if not longer:
                break
            best = longer[0]
        words_of = [w for w in whole if w.startswith(best) and whole[w] >= 0.95 * stems[term]]
        key = (words_of[0], False) if words_of else (best, True)
        chosen[key] = max(chosen.get(key, 0.0), evidence.get(key, 0.0), evidence[term, True])
    for word in whole:
        chosen.setdefault((word, False), evidence[word, False])
    kept: list[tuple[str, bool]] = []
    beginnings: set[str] = set()
    covered: set[str] = set()
    for term, stem in sorted(chosen, key=lambda k: (-chosen[k], len(k[0]), k)):
        # neither a beginning of a term that says more, nor one that such a beginning covers
        if term in covered or any(term[:k] in beginnings for k in range(1, len(term) + 1)):
            continue
        kept.append((term, stem))
        covered.update(term[:k] for k in range(1, len(term) + 1))
        if stem:
            beginnings.add(term)
    return sorted(kept[:most])


class Matcher:
    """Matches of a lexicon in texts, with their context. One per worker and model."""

    def __init__(self, model: Model):
        self.model = model
        self.lexicon = Lexicon(model.terms)
        self.seen = SeenUnits(self._work, most=600_000)

    def _work(self, units: list[bytes]) -> list:
        """term * 4 + edits of a word that matches, nothing for others."""
        out = []
        for unit in units:
            word = normal(unit)
            found = self.lexicon.closest(word) if word else None
            out.append([found[0] * 4 + found[1]] if found else [])
        return out

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[tuple]]]:
        """Words per text, and per text its matches: (word number, term, edits, context, word)."""
        n = len(offsets) - 1
        per_text: list[list[tuple]] = [[] for _ in range(n)]
        lowered = LOWER[data]
        starts, ends, text = words(lowered, offsets, INSIDE)
        count = np.bincount(text, minlength=n) if len(text) else np.zeros(n, dtype=np.int64)
        if len(starts):
            number = self.seen.numbers(lowered, starts, ends)
            first = np.cumsum(count) - count
            raw = data.tobytes()
            for k in np.flatnonzero(self.seen.lengths(number) > 0).tolist():
                t, code = int(text[k]), int(self.seen.flat[self.seen.bounds[number[k]]])
                low, high = max(k - AROUND, int(first[t])), min(k + AROUND, int(first[t] + count[t]) - 1)
                before = raw[starts[low]:starts[k]].decode("utf-8", "replace")
                after = raw[ends[k]:ends[high]].decode("utf-8", "replace")
                # a mark right before the first context word belongs to it
                if low == int(first[t]):
                    before = raw[offsets[t]:starts[k]].decode("utf-8", "replace")
                if high == int(first[t] + count[t]) - 1:
                    after = raw[ends[k]:offsets[t + 1]].decode("utf-8", "replace")
                word = raw[starts[k]:ends[k]].decode("utf-8", "replace")
                per_text[t].append((k - int(first[t]), code // 4, code % 4, _context(before, word, after), word.lower()))
        return count, per_text


def _context(before: str, word: str, after: str) -> str:
    near = set(re.findall(r"[^\W\d_]+", (before + " " + after).lower()))
    marked = (OPENING.search(before) or OPENING.match(word)) and (CLOSING.search(after) or CLOSING.search(word[-1:]))
    if marked or near & REPORTING:
        return "quotation"
    return "address" if near & ADDRESS else "plain"


def features(model: Model, matches: list[tuple]) -> list[float]:
    """Weight of different matched words in abuse, the same in quotation, most matches within ``CLOSE`` words (log)."""
    abuse: dict[str, float] = {}
    quoted: dict[str, float] = {}
    places = []
    for place, term, edits, context, word in matches:
        weight = model.weights.get((term, edits), 0.0)
        if weight <= 0:
            continue
        into = quoted if context == "quotation" else abuse
        into[word] = max(into.get(word, 0.0), weight * (1.25 if context == "address" else 1.0))
        if context != "quotation":
            places.append(place)
    at = np.sort(np.array(places, dtype=np.int64))
    dense = int((np.searchsorted(at, at + CLOSE) - np.arange(len(at))).max(initial=0))
    return [1.0, min(sum(abuse.values()), 20.0), min(sum(quoted.values()), 20.0), math.log1p(dense)]


_matchers: dict[tuple, Matcher] = {}


def matcher(model: Model) -> Matcher:
    key = (tuple(model.terms), tuple(sorted(model.weights.items())))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(model)
    return _matchers[key]


def _sample_matches(sample: DataFrame, model: Model) -> list:
    """Per sample text: its label and matches; the sample bounds what comes back."""
    def rows(batches):
        found = matcher(model)
        for batch, i, j, part, at in _texts(batches):
            _, per_text = found.matches(part, at)
            kind = pa.list_(pa.struct([("place", pa.int64()), ("term", pa.int64()), ("edits", pa.int64()), ("context", pa.string()), ("word", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(i, j - i).cast(pa.int32()),
                 pa.array([[dict(zip(("place", "term", "edits", "context", "word"), x)) for x in m] for m in per_text], kind)], ["label", "matches"])
    return sample.select("text", "label").mapInArrow(
        rows, "label int, matches array<struct<place:long,term:long,edits:long,context:string,word:string>>").collect()


def _sample_terms(sample: DataFrame, terms: list[tuple[str, bool]]) -> list:
    """Per sample text: its label and the numbers of the terms that occur in it as they are."""
    model = Model(terms=terms)

    def rows(batches):
        found = matcher(model)
        for batch, i, j, part, at in _texts(batches):
            _, per_text = found.matches(part, at)
            numbers = [np.array(sorted({t for _, t, e, _, _ in m if not e}), dtype="<u2").tobytes() for m in per_text]
            yield pa.RecordBatch.from_arrays([batch.column("label").slice(i, j - i).cast(pa.int32()), pa.array(numbers, pa.binary())],
                                             ["label", "terms"])
    return sample.select("text", "label").mapInArrow(rows, "label int, terms binary").collect()


def evidence(toxic, clean, n1: int, n0: int):
    """Likelihood ratio of a term's occurrence in toxic and clean texts (G²); numbers or arrays."""
    share = (toxic + clean) / (n1 + n0)
    out = 0.0
    for seen, n, expected in ((toxic, n1, share), (clean, n0, share), (n1 - toxic, n1, 1 - share), (n0 - clean, n0, 1 - share)):
        ratio = np.where(seen > 0, seen / np.maximum(n * expected, 1e-12), 1.0)
        out = out + 2 * seen * np.log(ratio)
    return out


def explaining_terms(terms: list[tuple[str, bool]], rows: list, most: int = TERMS) -> list[tuple[str, bool]]:
    """Of candidates those with most evidence in the toxic texts that the terms before them leave unexplained.

    Terms that explain nothing new, but whose own evidence is of the order of these terms', belong to the same vocabulary
    and are taken as well; words of a text that happens to be copied often are not.
    """
    labels = np.array([r["label"] for r in rows])
    has = np.zeros((len(rows), len(terms)), dtype=bool)
    for k, r in enumerate(rows):
        has[k, np.frombuffer(r["terms"], dtype="<u2").astype(np.int64)] = True
    n0 = int((labels == 0).sum())
    clean = has[labels == 0].sum(axis=0)
    toxic_rows = has[labels == 1]
    open_rows = np.ones(len(toxic_rows), dtype=bool)
    chosen: list[int] = []
    while len(chosen) < most and open_rows.any():
        toxic, n1 = toxic_rows[open_rows].sum(axis=0), int(open_rows.sum())
        gain = np.where(toxic * n0 > RATIO * clean * n1, evidence(toxic.astype(float), clean.astype(float), n1, n0), 0.0)
        best = int(gain.argmax())
        if gain[best] < EVIDENCE:
            break
        chosen.append(best)
        open_rows &= ~toxic_rows[:, best]
    whole = evidence(toxic_rows.sum(axis=0).astype(float), clean.astype(float), len(toxic_rows), n0)
    level = KINDRED * float(np.median(whole[chosen])) if chosen else np.inf
    alike = [int(k) for k in np.argsort(-whole, kind="stable") if whole[k] >= max(level, EVIDENCE) and k not in chosen]
    return [terms[k] for k in sorted(chosen + alike[:most - len(chosen)])]


def _fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton steps on the penalised likelihood; quotation starts, and is drawn, to a third of abuse."""
    prior = np.array([math.log((y.mean() + 1e-4) / (1 - y.mean() + 1e-4)), 1.0, 0.33, 0.0])
    penalty = np.diag([1e-3, ridge, 1.0, 1.0]) * len(y) ** 0.5
    b = prior.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (y - p) - penalty @ (b - prior)
        curve = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, gradient)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


def fit(labelled: DataFrame) -> Model:
    """A model from (text, label), label 0 or 1; see ``sample_of`` for the bound on its rows."""
    given = labelled.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("label").cast("int").alias("label"))
    sample = stage(unlike(given), "toxicity-sample")
    counts = stage(_term_counts(sample), "terms")
    total = counts.where("term = '' AND NOT stem").agg(F.sum("toxic"), F.sum("clean")).first()
    n1, n0 = int(total[0] or 0), int(total[1] or 0)
    if not n1 or not n0:
        return Model(coefficients=[30.0 if n1 else -30.0, 0.0, 0.0, 0.0]) if n1 or n0 else Model()
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    found = counts.where("term != ''").where((a / n1 > RATIO * b / n0) & (a >= 3)).orderBy(
        F.desc((a / n1 - b / n0) * F.sqrt(a)), "term", "stem").limit(8 * CANDIDATES).collect()
    strong = [{**r.asDict(), "evidence": float(evidence(float(r["toxic"]), float(r["clean"]), n1, n0))} for r in found]
    candidates = candidate_terms([r for r in strong if r["evidence"] >= EVIDENCE])
    model = Model(terms=explaining_terms(candidates, _sample_terms(sample, candidates)) if candidates else [])
    rows = _sample_matches(sample, model)
    hits = {0: Counter(), 1: Counter()}
    for r in rows:
        hits[r["label"]].update({(m["term"], m["edits"]) for m in r["matches"]})
    for key in set(hits[0]) | set(hits[1]):
        toxic, clean = hits[1][key], hits[0][key]
        exact = hits[1][key[0], 0], hits[0][key[0], 0]
        if key[1] and toxic + clean < 3:  # hardly seen: part of the exact term's weight
            toxic, clean = exact
            factor = 0.6
        else:
            factor = 1.0
        model.weights[key] = factor * min(max(math.log((toxic + 0.5) / (n1 + 1)) - math.log((clean + 0.5) / (n0 + 1)), 0.0), 6.0)
    for number, (term, stem) in enumerate(model.terms):   # edits never seen in the sample
        for edits in (1, 2):
            model.weights.setdefault((number, edits), 0.6 * model.weights.get((number, 0), 0.0))
    x = np.array([features(model, [(m["place"], m["term"], m["edits"], m["context"], m["word"]) for m in r["matches"]]) for r in rows])
    model.coefficients = _fit_logistic(x, np.array([float(r["label"]) for r in rows])).tolist()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted, matched (words), contexts.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null, empty and blank texts have no matches and
    get the score of such texts. Texts are read whole, however long.
    """
    def rows(batches):
        found = matcher(model)
        coefficients = np.array(model.coefficients)
        for batch, i, j, part, at in _texts(batches):
            _, per_text = found.matches(part, at)
            x = np.array([features(model, m) for m in per_text])
            scores = 1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), pa.array(scores, pa.float64()),
                 pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32()),
                 pa.array([[w for *_, w in m] for m in per_text], pa.list_(pa.string())),
                 pa.array([[c for *_, c, _ in m] for m in per_text], pa.list_(pa.string()))],
                ["doc_id", "score", "predicted", "matched", "contexts"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(rows, "doc_id long, score double, predicted int, matched array<string>, contexts array<string>")


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they were; nothing is shuffled."""
    def rows(batches):
        found = matcher(model)
        coefficients = np.array(model.coefficients)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            keep = []
            for i, j in chunks(offsets):
                _, per_text = found.matches(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                x = np.array([features(model, m) for m in per_text])
                keep.append(1 / (1 + np.exp(-np.clip(x @ coefficients, -30, 30))) < THRESHOLD)
            yield batch.filter(pa.array(np.concatenate(keep) if keep else [], pa.bool_()))
    return docs.mapInArrow(rows, docs.schema)


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(text, label) of the labelled rows outside the held-out quarter: crc32 of the id as text modulo 4 is not 2."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != 2)
    # the sample is bounded by SAMPLE, so its ids may be broadcast
    chosen = F.broadcast(sample_of(usable))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id").select("text", "label")
