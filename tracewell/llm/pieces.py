"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

Reading a text letter by letter, the automaton's state names the longest piece that ends there, its output links the
shorter ones; each of them relaxes what is best at that position. A letter without a piece falls back to its bytes.

* Unigram models: the best is the highest sum of scores; of equal ones that with the longer last piece.
* BPE models: their scores are ranks of merges, whose sum means nothing. A segmentation is the model's own if
  merging leaves each two neighbours as they are, and each prefix of a text has just one such segmentation. So a piece
  is reached from the last piece before it if merging the two texts gives these two pieces; the first one
  along the output links that is so reached is the best.

Pieces have the blank sign only at their beginning, or consist of nothing else. So the segmentation of a
text is that of its stretches from one run of blanks to the next, and each different stretch is worked out
once per worker; stretches that are new are segmented together, position by position, with numpy.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tracewell.llm.textbytes import SeenUnits, chunks, mix, spread, text_buffer, text_of_each

BLANK = "▁"
PENALTY = 10.0
TOGETHER = 4096      # stretches segmented at once
CELLS = 1 << 18      # letters of them at most, beyond a single one


class Automaton:
    """Trie of the pieces with failure and output links, in arrays."""

    def __init__(self, pieces: list[tuple[int, str, float]]):
        """``pieces``: (id, text, score)."""
        letters = sorted({c for _, text, _ in pieces for c in text})
        self.kind = np.zeros(0x110000, dtype=np.int64)
        self.kind[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.kinds = len(letters) + 1
        child: list[dict[int, int]] = [{}]
        self.piece = [-1]
        depth = [0]
        score_of = {}
        for number, text, score in pieces:
            node = 0
            for c in self.kind[[ord(c) for c in text]].tolist():
                if c not in child[node]:
                    child[node][c] = len(child)
                    child.append({})
                    self.piece.append(-1)
                    depth.append(depth[node] + 1)
                node = child[node][c]
            self.piece[node] = number
            score_of[node] = score
        n = len(child)
        fail, output = [0] * n, [0] * n      # output: the state itself if it ends a piece, else the next that does
        queue = deque(child[0].values())
        for node in child[0].values():
            output[node] = node if self.piece[node] >= 0 else 0
        while queue:
            node = queue.popleft()
            for c, target in child[node].items():
                back = fail[node]
                while back and c not in child[back]:
                    back = fail[back]
                fail[target] = child[back].get(c, 0)
                output[target] = target if self.piece[target] >= 0 else output[fail[target]]
                queue.append(target)
        keys = np.array([node * self.kinds + c for node in range(n) for c in child[node]], dtype=np.int64)
        targets = np.array([t for node in range(n) for t in child[node].values()], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.targets = keys[order], targets[order]
        self.fail, self.output = np.array(fail), np.array(output)
        self.next_output = self.output[self.fail]
        self.depth = np.array(depth)
        self.piece = np.array(self.piece)
        self.score = np.zeros(n)
        self.score[list(score_of)] = list(score_of.values())
        self.lowest = min((s for _, _, s in pieces), default=0.0) - PENALTY

    def step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """States after one more letter each."""
        out = np.zeros_like(state)
        todo = np.arange(len(state))
        while len(todo):
            key = state[todo] * self.kinds + kind[todo]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            out[todo[hit]] = self.targets[at[hit]]
            todo = todo[~hit & (state[todo] != 0)]
            state = state.copy()
            state[todo] = self.fail[state[todo]]
        return out

    def segment(self, codes: np.ndarray, lengths: np.ndarray, neighbours: "Neighbours | None") -> tuple[np.ndarray, np.ndarray]:
        """Best last piece (-1: fallback) and its length at each end position of each row; rows are padded with 0.

        With ``neighbours`` a piece must be a neighbour of the last piece before it; without, scores decide.
        """
        rows, most = codes.shape
        kinds = self.kind[codes]
        best = np.full((rows, most + 1), -np.inf)
        best[:, 0] = 0
        last = np.full((rows, most + 1), -1, dtype=np.int64)
        size = np.ones((rows, most + 1), dtype=np.int64)
        state = np.zeros(rows, dtype=np.int64)
        live = np.arange(rows)
        for p in range(1, most + 1):
            live = live[lengths[live] >= p]
            state[live] = self.step(state[live], kinds[live, p - 1])
            row, node = live, self.output[state[live]]
            single = np.zeros(rows, dtype=bool)
            while True:
                some = node > 0
                row, node = row[some], node[some]
                if not len(row):
                    break
                long = self.depth[node]
                if neighbours is None:
                    reached = best[row, p - long] + self.score[node]
                    better = reached > best[row, p]
                    single[row[long == 1]] = True
                else:
                    before = np.where(p == long, -1, last[row, p - long])
                    better = neighbours.are(before, self.piece[node])
                    reached = np.zeros(len(row))
                    single[row[better]] = True
                best[row[better], p] = reached[better]
                last[row[better], p] = self.piece[node[better]]
                size[row[better], p] = long[better]
                node = self.next_output[node]
                if neighbours is not None:
                    row, node = row[~better], node[~better]
            alone = live[~single[live]]
            reached = best[alone, p - 1] + self.lowest
            better = alone[reached > best[alone, p]]
            best[better, p] = best[better, p - 1] + self.lowest
            last[better, p] = -1
            size[better, p] = 1
        return last, size


class Neighbours:
    """Which pieces BPE leaves side by side, worked out by merging their texts, once per pair and worker."""

    def __init__(self, number: dict[str, int], score: dict[str, float]):
        self.number, self.score = number, score
        self.text = {n: t for t, n in number.items()}
        self.base = np.uint64(max(self.text, default=0) + 2)
        self.seen = SeenUnits(self._work, most=1_000_000, dtype=np.uint8)

    def merged(self, text: str) -> list[str]:
        """Plain BPE: the neighbours whose union has the best score become one, the leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            unions = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
            some = [u for u in unions if u is not None]
            if not some:
                break
            k = unions.index(max(some))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _work(self, pairs: list[tuple[int, int]]) -> list:
        out = []
        for a, b in pairs:
            first, second = self.text.get(a, ""), self.text[b]
            out.append([self.merged(first + second) == ([first, second] if first else [second])])
        return out

    def are(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """first: -1 for the beginning or a letter without a piece, which merges with nothing."""
        key = mix((first + 1).astype(np.uint64) * self.base + second.astype(np.uint64) + np.uint64(1))
        number = self.seen.numbers_of(key, lambda at: list(zip(first[at].tolist(), second[at].tolist())))
        return self.seen.flat[self.seen.bounds[number]] > 0


class Pieces:
    """A model file's pieces, their automaton, and the stretches met so far."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model.serialized_model_proto())
        merges = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        n = model.get_piece_size()
        special = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_ids = np.array([i for i in range(n) if model.is_byte(i)], dtype=np.int64)
        byte_of = {i: bytes([int(model.id_to_piece(i)[1:-1], 16)]) for i in self.byte_ids.tolist()}
        self.byte_ids = np.array(sorted(byte_of, key=lambda i: byte_of[i]), dtype=np.int64)
        self.unknown = model.unk_id()
        self.normal = [(i, model.id_to_piece(i), model.get_score(i)) for i in range(n) if i not in special and i not in byte_of]
        self.merges = merges
        written = [b"" if i in special else byte_of.get(i) or model.id_to_piece(i).replace(BLANK, " ").encode() for i in range(n)]
        if self.unknown >= 0:
            written[self.unknown] = " ⁇ ".encode()
        self.written = np.frombuffer(b"".join(written), dtype=np.uint8)
        ends = np.cumsum([len(w) for w in written])
        self.written_length = np.array([len(w) for w in written], dtype=np.int64)
        self.written_start = ends - self.written_length
        self.seen: SeenUnits | None = None

    def _prepare(self) -> None:
        """What encoding needs beyond decoding; workers that only decode don't hold it."""
        self.automaton = Automaton(self.normal)
        self.neighbours = Neighbours({t: i for i, t, _ in self.normal}, {t: s for _, t, s in self.normal}) if self.merges else None
        self.seen = SeenUnits(self.segment_all)

    def segment_all(self, stretches: list[bytes]) -> list:
        """Ids of each stretch; stretches of like length go together."""
        texts = [s.decode("utf-8", "replace").replace(" ", BLANK) for s in stretches]
        order = sorted(range(len(texts)), key=lambda k: len(texts[k]))
        out: list = [None] * len(texts)
        a = 0
        while a < len(order):
            b = a + 1
            while b < len(order) and b - a < TOGETHER and (b + 1 - a) * len(texts[order[b]]) <= CELLS:
                b += 1
            self._segment([texts[k] for k in order[a:b]], order[a:b], out)
            a = b
        return out

    def _segment(self, texts: list[str], places: list[int], out: list) -> None:
        lengths = np.array([len(t) for t in texts])
        most = int(lengths.max())
        codes = np.zeros((len(texts), most), dtype=np.int64)
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes[np.arange(most) < lengths[:, None]] = flat
        last, size = self.automaton.segment(codes, lengths, self.neighbours)
        at = lengths.copy()
        live = np.flatnonzero(at > 0)
        found, rows, froms = [], [], []
        while len(live):
            found.append(last[live, at[live]])
            rows.append(live)
            at[live] -= size[live, at[live]]
            froms.append(at[live].copy())
            live = live[at[live] > 0]
        if not found:
            for k in places:
                out[k] = []
            return
        ids, row, start = (np.concatenate(v) for v in (found, rows, froms))
        order = np.lexsort((start, row))
        ids, row, start = ids[order], row[order], start[order]
        bounds = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            mine = ids[a:b]
            if b > a and mine.min() < 0:
                mine = np.concatenate([[i] if i >= 0 else self._fallback(texts[k][s]) for i, s in zip(mine.tolist(), start[a:b].tolist())])
            out[places[k]] = mine

    def _fallback(self, letter: str) -> list[int]:
        if not len(self.byte_ids):
            return [self.unknown]
        return self.byte_ids[list(letter.encode("utf-8", "replace"))].tolist()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, and how many each has."""
        if self.seen is None:
            self._prepare()
        n = len(offsets) - 1
        full = np.diff(offsets) > 0
        if not full.any():
            return np.zeros(0, dtype=np.uint32), np.zeros(n, dtype=np.int64)
        data = np.insert(data, offsets[:-1][full], 32)         # each text begins with a blank
        offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        blank = data == 32
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[1:-1] = blank[1:] & ~blank[:-1]
        sign = np.flatnonzero(data == 0xE2)                     # the blank sign itself, written in a text, is one too
        sign = sign[sign + 3 < len(data)]
        sign = sign[(data[sign + 1] == 0x96) & (data[sign + 2] == 0x81)]
        edge[sign + 3] = False
        edge[offsets] = True
        at = np.flatnonzero(edge)
        number = self.seen.numbers(data, at[:-1], at[1:])
        counts = np.bincount(text_of_each(at[:-1], offsets), weights=self.seen.lengths(number), minlength=n)
        return self.seen.gather(number), counts.astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of ids; the blank that encoding put in front goes."""
        raw = self.written[spread(self.written_start[ids], self.written_length[ids])].tobytes()
        return raw[1:] if raw[:1] == b" " else raw


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_pieces(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pieces, ids (little-endian unsigned 32 bit).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null and empty texts have no pieces; other white space
    than blanks has its own pieces or bytes. Equal texts have equal ids. ``path`` is the model file, on every executor.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for i, j in chunks(offsets):
                ids, counts = model.encode(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                out = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(counts, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "n_pieces", "ids"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(rows, "doc_id long, n_pieces long, ids binary")


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, ids, text): the text of each row's ids; bytes that are no UTF-8 become U+FFFD, null ids no text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            texts = [None if not v.is_valid else model.decode(np.frombuffer(v.as_buffer(), dtype="<u4")).decode("utf-8", "replace")
                     for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])
    return encoded.select("doc_id", "n_pieces", "ids").mapInArrow(rows, "doc_id long, n_pieces long, ids binary, text string")
