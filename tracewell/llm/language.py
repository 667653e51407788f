"""Language identification with a string kernel: blended-spectrum n-gram presence, Nyström landmarks, ridge regression.

The kernel of two texts is the sum over n of |G_n(x) ∩ G_n(y)| / sqrt(|G_n(x)| |G_n(y)|), G_n being the set of n-byte
sequences of the lower-cased letters of a text. Landmarks, chosen from the sample, give the Nyström features; one ridge
regression per language, against all others, runs on them. As the kernel is an inner product of presence vectors,
the product of landmarks and coefficients is taken once: a batch of texts is scored by multiplying its
sparse presence matrices with that small matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tracewell.llm.textbytes import LOWER, chunks, mix, text_buffer
from tracewell.session import stage

SIZES = {1: 256, 2: 1 << 13, 3: 1 << 15, 4: 1 << 16}   # n-gram length: hash buckets of its presence vector
SAMPLE = 3000        # labelled rows to fit on, over all languages
LANDMARKS = 400
LANGUAGES = 200      # most frequent ones that are learned
RIDGE = 1e-3
SHARPNESS = 6.0      # of the scores' softmax
GROUP = 64           # texts whose presence is held at once
STEP = 256           # sample texts made dense at once
STRETCH = 1 << 13    # features of them, and of the landmarks, made dense at once

FOLD = LOWER.copy()
FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32
OFFSETS = dict(zip(SIZES, np.cumsum([0, *SIZES.values()])[:-1].tolist()))
TOTAL = sum(SIZES.values())
UNKNOWN = "und"
LEAST_SCORE = 0.3


def presence(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, end, text of each feature, feature, its weight 1/sqrt(|G_n|)) for groups of texts."""
    for i in range(0, len(offsets) - 1, GROUP):
        j = min(i + GROUP, len(offsets) - 1)
        part = FOLD[data[offsets[i]:offsets[j]]].astype(np.uint32)
        at = offsets[i:j + 1] - offsets[i]
        owner = np.repeat(np.arange(j - i), np.diff(at))
        # a run of other signs counts as one blank, and the text begins and ends with one
        blank = part == 32
        keep = np.ones(len(part), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))
        part, owner = part[keep], owner[keep]
        out = []
        code = np.zeros(len(part), dtype=np.uint64)
        for n, size in SIZES.items():
            if len(part) < n:
                break
            code = code[:len(part) - n + 1] * np.uint64(257) + part[n - 1:].astype(np.uint64)
            inside = owner[:len(part) - n + 1] == owner[n - 1:]
            bucket = (mix(code) >> np.uint64(32)).astype(np.int64) % size if n > 1 else code.astype(np.int64)
            seen = np.zeros((j - i) * size, dtype=bool)
            seen[owner[:len(part) - n + 1][inside] * size + bucket[inside]] = True
            if n == 1:
                seen.reshape(j - i, size)[:, 32] = False
            found = np.flatnonzero(seen)
            text = found // size
            count = np.bincount(text, minlength=j - i)
            out.append((text, found % size + OFFSETS[n], 1 / np.sqrt(np.maximum(count, 1))[text]))
        if out:
            yield (i, j, *(np.concatenate(v) for v in zip(*out)))
        else:
            none = np.zeros(0, dtype=np.int64)
            yield i, j, none, none, np.zeros(0)


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without ASCII letters are decoded."""
    ascii_letter = (LOWER[data] >= 97) & (LOWER[data] <= 122)
    total = np.concatenate([[0], np.cumsum(ascii_letter)])
    out = total[offsets[1:]] > total[offsets[:-1]]
    for k in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        out[k] = any(c.isalpha() for c in data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace"))
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray      # TOTAL x languages: landmarks' presence times Nyström and ridge coefficients
    constant: np.ndarray


def sample_of(labelled: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """About ``rows`` rows of (doc_id, text, lang), as many of each language, chosen by a hash of the id."""
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    each = rows / max(len(counts), 1)
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, each / n)).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / 1e6
    return labelled.where(draw < share)


def _sample_presence(sample: DataFrame) -> DataFrame:
    """(lang, bits, draw) of the texts with a letter: presence bits, TOTAL / 8 bytes a text however long it is; draw is a hash of both."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in chunks(offsets):
                at = offsets[a:b + 1] - offsets[a]
                part = data[offsets[a]:offsets[b]]
                letters = has_letter(part, at)
                for i, j, text, feature, _ in presence(part, at):
                    bits = np.zeros((j - i, TOTAL), dtype=bool)
                    bits[text, feature] = True
                    packed = [row.tobytes() if ok else None for row, ok in zip(np.packbits(bits, axis=1), letters[i:j])]
                    yield pa.RecordBatch.from_arrays([batch.column("lang").slice(a + i, j - i), pa.array(packed, pa.binary())], ["lang", "bits"])
    got = sample.select("text", "lang").mapInArrow(rows, "lang string, bits binary").where("bits IS NOT NULL")
    return got.withColumn("draw", F.xxhash64("bits", "lang"))


def _landmarks(table: DataFrame) -> np.ndarray:
    """Presence bits of the first ``LANDMARKS`` rows in the order of the hash, a random choice."""
    draws = sorted(r["draw"] for r in table.select("draw").collect())
    if not draws:
        return np.zeros((0, TOTAL // 8), dtype=np.uint8)
    lowest = table.where(F.col("draw") <= draws[:LANDMARKS][-1]).groupBy("draw", "lang", "bits").agg(F.count("*").alias("n")).collect()
    lowest.sort(key=lambda r: (r["draw"], r["lang"]))
    bits = np.stack([np.frombuffer(r["bits"], dtype=np.uint8) for r in lowest])
    return np.repeat(bits, [r["n"] for r in lowest], axis=0)[:LANDMARKS]


def _weighted(bits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """First feature, and rows of presence divided by the root of their number for that length, of ``STRETCH`` features at a time."""
    for n, size in SIZES.items():
        block = bits[:, OFFSETS[n] // 8:(OFFSETS[n] + size) // 8]
        root = np.sqrt(np.maximum(np.bitwise_count(block).sum(axis=1, keepdims=True), 1)).astype(np.float32)
        for a in range(0, size, STRETCH):
            yield OFFSETS[n] + a, np.unpackbits(block[:, a // 8:(a + STRETCH) // 8], axis=1) / root


def _kernel(bits: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The kernel of each row of presence bits with each of ``first``."""
    out = np.zeros((len(bits), len(first)))
    for (_, rows), (_, landmarks) in zip(_weighted(bits), _weighted(first)):
        out += rows @ landmarks.T
    return out


def _kernel_rows(table: DataFrame, first: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """The kernel of the sample with the landmarks and the languages, in the order of the hash; made where the rows are."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, STEP):
                part = batch.slice(a, STEP)
                bits = np.stack([np.frombuffer(b, dtype=np.uint8) for b in part.column("bits").to_pylist()])
                kernel = [row.tobytes() for row in _kernel(bits, first)]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("draw"), pa.array(kernel, pa.binary())], ["lang", "draw", "kernel"])
    got = table.mapInArrow(rows, "lang string, draw long, kernel binary").collect()
    got.sort(key=lambda r: (r["draw"], r["lang"]))
    kernel = np.zeros((len(got), len(first)))
    for k, r in enumerate(got):
        kernel[k] = np.frombuffer(r["kernel"])
    return kernel, [r["lang"] for r in got]


def fit(labelled: DataFrame) -> Model:
    """A model from (doc_id, text, lang); rows without a language don't count. The sample is bounded by ``SAMPLE``."""
    usable = labelled.where("lang IS NOT NULL").select("doc_id", F.col("text").cast("string").alias("text"), "lang")
    table = stage(_sample_presence(stage(sample_of(usable), "language-sample")), "language-presence")
    first = _landmarks(table)
    kernel, langs = _kernel_rows(table, first)
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((TOTAL, 0), dtype=np.float32), np.zeros(0))
    among = kernel[:len(first)]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])             # Nyström: K(., landmarks) times this
    features = kernel @ whiten
    del kernel, among
    targets = np.where(np.array(langs)[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    weight = np.array([1 / langs.count(x) for x in langs])
    weight *= len(langs) / weight.sum()
    centre = (features * weight[:, None]).mean(axis=0)
    middle = (targets * weight[:, None]).mean(axis=0)
    features -= centre
    gram = features.T @ (features * weight[:, None]) + RIDGE * len(langs) * np.eye(features.shape[1])
    ridge = np.linalg.solve(gram, features.T @ ((targets - middle) * weight[:, None]))
    # scores = K(x, landmarks) whiten ridge + constant = presence(x) (landmarks^T whiten ridge) + constant
    coefficients = (whiten @ ridge).astype(np.float32)
    folded = np.zeros((TOTAL, len(languages)), dtype=np.float32)
    for begin, landmarks in _weighted(first):
        folded[begin:begin + landmarks.shape[1]] = landmarks.T @ coefficients
    return Model(languages, folded, middle - centre @ ridge)


def _predicted(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    letters = has_letter(data, offsets)
    names, scores = [UNKNOWN] * (len(offsets) - 1), np.zeros(len(offsets) - 1)
    if not model.languages:
        return names, scores
    for i, j, text, feature, weight in presence(data, offsets):
        values = np.zeros((j - i, len(model.languages)))
        product = model.table[feature] * weight[:, None].astype(np.float32)
        for c in range(len(model.languages)):
            values[:, c] = np.bincount(text, weights=product[:, c], minlength=j - i)
        values += model.constant
        share = np.exp(SHARPNESS * (values - values.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = values.argmax(axis=1)
        for k in np.flatnonzero(letters[i:j]).tolist():
            names[i + k], scores[i + k] = model.languages[best[k]], share[k, best[k]]
    return names, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (0 to 1).

    Only ``text`` enters a prediction; ``docs`` needs it and ``doc_id``, other columns are ignored. Null texts, texts without a
    letter, and all texts if the model knows no language, are ``und`` with score 0. Ties go to the first language in
    alphabetical order. The score is the share of the chosen language in a softmax of the regressions.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for a, b in chunks(offsets):
                names, scores = _predicted(model, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(rows, "doc_id long, lang_pred string, score double")


def drop_unknown(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` in a language the model tells from the others, all columns as they were.

    Rejected are texts without a letter and those whose best language has a score under ``least``; nothing is shuffled. A
    model that knows no language rejects every text.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            keep: list[bool] = []
            for a, b in chunks(offsets):
                names, scores = _predicted(model, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                keep += [n != UNKNOWN and v >= least for n, v in zip(names, scores.tolist())]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(rows, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from fitting: crc32 of the id as text modulo 5 is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
