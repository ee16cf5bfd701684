"""Streaming Viterbi encoding and decoding for SentencePiece models.

The lattice of a text has a node at each character boundary and an arc for each vocabulary
piece; a character that no piece covers takes its byte pieces. One pass keeps a surviving
backpointer for each boundary of a window and commits ids as soon as all surviving paths go
through one boundary, so memory is bounded by the longest piece and the longest stretch
without convergence, not by the text.

Survivors are chosen by the model's type:

* unigram: the path with the highest sum of piece scores (Viterbi proper);
* BPE: the path that merging by rank would give. Its last piece at a boundary is the only
  piece t for which the encoding of what stands before ends in a piece s such that merging
  ``s + t`` gives back s, t; so each boundary has one survivor and no scores are added.
  (Adding BPE scores, which are ranks, would not give the model's own ids.)

A boundary is alive while a longer piece may still begin there, so the window is seldom longer
than a word. What a window becomes by its next character depends on it alone: such steps, and
the words that lead from a lone word mark to a lone word mark, are remembered in bounded
tables. Decoding concatenates pieces and bytes and takes off the leading mark.

The model is read from a path that every executor sees; it's a parameter.

Edge cases: null and empty texts have no ids and decode to an empty text; control
characters and characters outside the vocabulary use byte pieces; very long texts stream;
repeated rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import small_batches, table

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIGRAM, BPE = 1, 2
#: Remembered steps between windows, words and pairs of pieces; beyond it they are dropped.
_STEPS = 600_000
_WORDS = 300_000
_PAIRS = 300_000


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


class _Window(dict):
    """The characters since the last commitment with their survivors; by the next character,
    the window after it and the ids that it commits. Steps are computed when first taken."""

    __slots__ = ("alive", "codec", "held", "known")

    def __init__(self, codec: Codec, held: str, known: tuple, alive: tuple[int, ...]):
        self.codec, self.held, self.known, self.alive = codec, held, known, alive

    def __missing__(self, char: str) -> tuple[_Window, bytes]:
        codec = self.codec
        if codec._steps >= _STEPS:
            codec._forget()
        codec._steps += 1
        *window, ids = codec._advance(self.held + char, self.known, self.alive)
        step = self[char] = (codec._state(*window), _packed(ids))
        return step


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one protocol-buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        elif tag & 7 == 1:
            value, at = data[at : at + 8], at + 8
        elif tag & 7 == 2:
            n, at = _varint(data, at)
            value, at = data[at : at + n], at + n
        elif tag & 7 == 5:
            value, at = data[at : at + 4], at + 4
        else:
            raise ValueError("not a model file")
        yield tag >> 3, value


class _Words(dict):
    """By a word, the ids that it and the mark after it commit, from the window of a lone mark;
    None where that isn't the window again afterwards."""

    __slots__ = ("codec",)

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, word: str) -> bytes | None:
        state, found = self.codec._mark, b""
        for char in word:
            state, ids = state[char]
            if ids:
                found += ids
        state, ids = state[MARK]
        found = found + ids if state is self.codec._mark else None
        if len(word) <= 64:
            if len(self) >= _WORDS:
                self.clear()
            self[word] = found
        return found


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: bytes):
        self.kind, self.dummy_prefix = UNIGRAM, True
        self.pieces: list[str] = []
        self.scores: list[float] = []
        types: list[int] = []
        for field, value in _message(model):
            if field == 1:
                entry = dict(_message(value))
                self.pieces.append(entry[1].decode())
                self.scores.append(float(np.frombuffer(entry.get(2, b"\0\0\0\0"), "<f4")[0]))
                types.append(entry.get(3, 1))
            elif field == 2:
                self.kind = dict(_message(value)).get(3, UNIGRAM)
            elif field == 3:
                norm = dict(_message(value))
                self.dummy_prefix = bool(norm.get(3, 1))
                if norm.get(2) or norm.get(4):
                    raise ValueError("models that rewrite characters or drop blanks are not supported")
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.ids = {p: i for i, (p, t) in enumerate(zip(self.pieces, types, strict=True)) if t in (1, 4)}
        self.unknown = types.index(2) if 2 in types else 0
        self.bytes = {int(p[3:5], 16): i for i, (p, t) in enumerate(zip(self.pieces, types, strict=True)) if t == 6}
        self.longest = max(map(len, self.ids), default=1)
        self._byte_of = {i: b for b, i in self.bytes.items()}
        self._lowest = min((self.scores[i] for i in self.ids.values()), default=0.0)
        self.rank = [-x for x in self.scores]
        self._halves: dict[int, tuple[int, int]] = {}
        self._pairs: dict[int, bool] = {}
        #: Proper beginnings of pieces, and the pairs of characters that stand in a row in one.
        self._beginnings = {p[:n] for p in self.ids for n in range(1, len(p))}
        self._inside = {p[n : n + 2] for p in self.ids for n in range(len(p) - 1)}
        self._windows: dict[tuple, _Window] = {}
        self._words = _Words(self)
        self._forget()
        self._plain = [chr(self._byte_of[i]) if self._byte_of.get(i, 128) < 128 else p for i, p in enumerate(self.pieces)]
        self._high = {i for i, b in self._byte_of.items() if b >= 128}

    def halves(self, piece: int) -> tuple[int, int]:
        """The two pieces whose merging makes this one from its characters; (-1, -1) for one
        character, (-2, -2) where merging never makes it."""
        known = self._halves.get(piece)
        if known is None:
            text = self.pieces[piece]
            parts = [self.ids.get(c, -1) for c in text]
            known = (-1, -1)
            while len(parts) > 1:
                best, at, made = 0.0, -1, -1
                for i in range(len(parts) - 1):
                    if parts[i] < 0 or parts[i + 1] < 0:
                        continue
                    whole = self.ids.get(self.pieces[parts[i]] + self.pieces[parts[i + 1]])
                    if whole is not None and (at < 0 or self.rank[whole] < best):
                        best, at, made = self.rank[whole], i, whole
                if at < 0:
                    known = (-2, -2)
                    break
                known = (parts[at], parts[at + 1])
                parts[at : at + 2] = [made]
            self._halves[piece] = known
        return known

    def stands(self, left: int, right: int) -> bool:
        """Whether merging never joins anything across the border of two pieces.

        The pieces are taken apart in the reverse of the order in which merging made them; at
        each moment the two parts at the border must not have been the next to merge.
        """
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is not None:
            return known
        if len(self._pairs) >= _PAIRS:
            self._pairs.clear()
        ids, pieces, rank = self.ids, self.pieces, self.rank
        limit, strict, ok = float("inf"), True, True
        x, y = left, right
        while True:
            whole = ids.get(pieces[x] + pieces[y])
            if whole is not None and (rank[whole] < limit or not strict and rank[whole] == limit):
                ok = False
                break
            x_parts, y_parts = self.halves(x), self.halves(y)
            if x_parts[0] < 0 and y_parts[0] < 0:
                break
            # The part made last is taken apart first; of equals the right one was made last.
            if y_parts[0] < 0 or x_parts[0] >= 0 and rank[x] > rank[y]:
                limit, strict, x = rank[x], True, x_parts[1]
            else:
                limit, strict, y = rank[y], False, y_parts[0]
        self._pairs[key] = ok
        return ok

    def _arc_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        found = [self.bytes.get(b) for b in piece.encode("utf-8", "surrogatepass")]
        return [self.unknown] if None in found else found

    def _cost(self, piece: int) -> float:
        return self.scores[piece] if piece >= 0 else self._lowest - 10.0

    def _advance(self, held: str, known: tuple, alive: tuple[int, ...]) -> tuple[str, tuple, tuple[int, ...], list[int]]:
        """The window after its last character came: (held, known, alive, committed ids).

        ``held`` has the characters since the last commitment, that one included; ``known`` the
        survivor (start, piece or -1, score) at each boundary before it, and ``alive`` the
        boundaries at which a piece may still begin that ends here or later.
        """
        ids, end = self.ids, len(held)
        best = None
        if self.kind == BPE:
            for start in alive:
                piece = ids.get(held[start:])
                if piece is not None:
                    before = known[start][1]
                    if (before < 0 or self.stands(before, piece)) and (end - start == 1 or self.halves(piece)[0] >= 0):
                        best = (start, piece, 0.0)
                        break
            best = best or (end - 1, -1, 0.0)
        else:
            best = (end - 1, -1, known[end - 1][2] + self._lowest - 10.0)
            for start in alive:
                piece = ids.get(held[start:])
                if piece is not None and known[start][2] + self.scores[piece] > best[2]:
                    best = (start, piece, known[start][2] + self.scores[piece])
        known = (*known, best)
        alive = (*(b for b in alive if held[b:] in self._beginnings), end)
        # Every later arc starts at one of these boundaries: where the paths behind them meet,
        # nothing that follows can change what stands before.
        paths, used = set(alive), set(alive)
        while len(paths) > 1:
            top = max(paths)
            paths.remove(top)
            paths.add(known[top][0])
            used.add(known[top][0])
        (meet,) = paths
        committed = self._walk(held, known, meet)
        before = known[meet][1]
        if meet < end and before >= 0 and (meet not in alive or self.pieces[before][-1] + held[meet] not in self._inside):
            before = -1  # no piece begins there any more, or nothing could join across
        moved: list[tuple[int, int, float] | None] = [(0, before, 0.0)]
        for b in range(meet + 1, end + 1):
            if b in used:
                start, piece, _ = known[b]
                score = 0.0 if self.kind == BPE else moved[start - meet][2] + self._cost(piece)
                moved.append((start - meet, piece, score))
            else:
                moved.append(None)  # on no surviving path
        return held[meet:], tuple(moved), tuple(b - meet for b in alive), committed

    def _state(self, held: str, known: tuple, alive: tuple[int, ...]) -> _Window:
        key = (held, known)
        state = self._windows.get(key)
        if state is None:
            state = self._windows[key] = _Window(self, held, known, alive)
        return state

    def _forget(self) -> None:
        """Bound the remembered steps; windows in use stay valid."""
        for state in self._windows.values():
            state.clear()
        self._windows.clear()
        self._steps = 0
        self._start = self._state("", ((0, -1, 0.0),), (0,))
        #: The window that holds a word mark and nothing before it.
        self._mark = self._state(MARK, ((0, -1, 0.0), (0, self.ids.get(MARK, -1), 0.0)), (0, 1))

    def stream(self, chars: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a stream of characters, committed as soon as all surviving paths agree.
        What is held is one window, whatever the stream's length."""
        state = self._start
        for char in chars:
            state, ids = state[char]
            if ids:
                yield np.frombuffer(ids, "<i4").tolist()
        yield self._walk(state.held, state.known, len(state.held))

    def _walk(self, held: str, known: list[tuple[int, int, float]], end: int) -> list[int]:
        out: list[list[int]] = []
        while end:
            start, piece, _ = known[end]
            out.append([piece] if piece >= 0 else self._arc_ids(held[start:end]))
            end = start
        return [i for ids in reversed(out) for i in ids]

    def encode_array(self, text: str) -> np.ndarray:
        """The ids of a whole text, as ``stream`` commits them.

        The stream goes by characters; a word that takes the window from a lone word mark to
        a lone word mark goes in one remembered step.
        """
        if not text:
            return np.empty(0, np.int32)
        words = text.replace(MARK, " ").split(" ")
        last = words.pop()
        state, out = self._start, []
        if self.dummy_prefix:
            state, ids = state[MARK]
            out.append(ids)
        if state is self._mark:
            out += map(self._words.__getitem__, words)
            if None in out:
                out = out[: out.index(None)]
                words = words[len(out) - 1 :]
            else:
                words = []
        add = out.append
        for word in words:
            if state is self._mark and (ids := self._words[word]) is not None:
                add(ids)
                continue
            for char in word + MARK:
                state, ids = state[char]
                add(ids)
        for char in last:
            state, ids = state[char]
            add(ids)
        add(_packed(self._walk(state.held, state.known, len(state.held))))
        return np.frombuffer(b"".join(out), "<i4")

    def encode(self, text: str) -> list[int]:
        return self.encode_array(text).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        if self._high.isdisjoint(ids):
            text = "".join(map(self._plain.__getitem__, ids))
        else:
            parts, pending = [], bytearray()
            for i in ids:
                b = self._byte_of.get(i)
                if b is not None:
                    pending.append(b)
                    continue
                if pending:
                    parts.append(pending.decode("utf-8", "replace"))
                    pending.clear()
                parts.append(self.pieces[i])
            parts.append(pending.decode("utf-8", "replace"))
            text = "".join(parts)
        text = text.replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    with open(path, "rb") as f:
        return Codec(f.read())


def encode_documents(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """All columns of ``docs`` named doc_id and text, with ids (array<int>), n_tokens and
    round_trip: whether decoding the ids gives the text back (its own word marks as spaces)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids: list[np.ndarray] = []
            same = []
            for text in texts:
                found = c.encode_array(text or "")
                same.append(c.decode(found.tolist()) == (text or "").replace(MARK, " "))
                ids.append(found)
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, pa.array(np.diff(ends).astype(np.int64)), pa.array(same, pa.bool_())], names=["doc_id", "text", "ids", "n_tokens", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, text string, ids array<int>, n_tokens long, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id and text from columns doc_id and ids."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def ids_sha256(ids: Iterable[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents")).drop("text")
