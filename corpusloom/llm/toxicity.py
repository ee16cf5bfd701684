"""Toxicity scoring behind a noisy-channel deobfuscator.

Restoring: a token that shows obfuscation (signs or digits between, before or after letters, a
letter three times in a row, single letters set apart by spaces or signs) becomes a character lattice in
which each sign may be itself, the letter it looks like, or nothing, and a repeated letter
may stand once or twice. Viterbi decoding under a character trigram model picks the most
likely string, at any length: where all paths meet, what stands before is settled. In any
other token the lattice has one path, which is the token itself.

The character model counts the trigrams of the whole corpus (sums of partial counts; its size
is bounded by the alphabet, its evidence grows with the input).

Scoring: restored words and their beginnings are hashed features. A bounded sample of the
labelled training rows (``sample_rows``, half of each class at most, by hash order) gives
their document counts by class; features that favour toxic documents are selected, and a
logistic model over their presence is fitted to the same rows. A score is that model's
probability.

Only rows with crc32(doc_id) mod 5 other than 0 are learned from; doc_id, lang, source and
labels are never inputs of a score.

Edge cases: null and empty texts score as any text without selected features does (the fit weighs
both classes alike); where no feature is selected, all score the share of toxic labels; with no
usable labels every score is 0; several labels of a doc_id count as toxic if one is; repeated rows get equal
scores; very long texts are scored whole; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import LOWER, Words, byte_class, groups, mix64, small_batches, stored, table, utf8_list

FEATURE_BITS = 20
PREFIXES = (4, 5, 6)
SELECTED = 4096
SAMPLE_ROWS = 120_000

# What a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
FILLERS = frozenset(".-_*~'^#=/\\ ")

#: Trigram alphabet: a-z, any other letter, and the edge of a word.
_OTHER, _EDGE, _SIZE = 26, 27, 28
_CODE = np.full(256, _EDGE, dtype=np.int64)
_CODE[97:123] = np.arange(26)
_CODE[128:] = _OTHER

_LETTERS = r"[^\W\d_]"
_SIGN = r"[0-9@$!|+(<€£.\-_*~'^#=/\\]"
_LOOK = r"[0-9@$!|+(<€£]"
_OTHERS = r"(?:[\d_]|[^\w\s])"
#: Single letters set apart, and what marks a token whose lattice has more than one path: signs
#: inside, before or after letters, or runs. No pattern repeats over what another start repeats
#: over, so each takes time linear in the text.
_SPACED_PATTERN = rf"(?<![^\s])(?:{_LETTERS}[ .\-_*~'^#=/\\]){{3,}}{_LETTERS}(?![^\s.,;:!?])"
_MARKED_PATTERN = (
    rf"{_LETTERS}{_SIGN}++{_LETTERS}|[0-9@$|+(<€£]{_LETTERS}|({_LETTERS})\1\1"
    rf"|{_LETTERS}(?={_OTHERS}*+(?!\S))(?:(?!{_LOOK}){_OTHERS})*+{_LOOK}"
)
_SPACED, _MARKED, _SUSPECT = re.compile(_SPACED_PATTERN), re.compile(_MARKED_PATTERN), re.compile(f"{_MARKED_PATTERN}|{_SPACED_PATTERN}")
_WORD_TABLE = byte_class([*range(0, 48), *range(58, 97), *range(123, 128)])


def trigram_counts(texts: list[bytes]) -> np.ndarray:
    """Counts (28 ** 3) of the trigrams of lower-cased bytes; runs of non-letters are one edge."""
    total = np.zeros(_SIZE**3, dtype=np.int64)
    for begin, end in groups(texts):
        code = _CODE[np.frombuffer(b" " + b" ".join(t.translate(LOWER) for t in texts[begin:end]) + b" ", dtype=np.uint8)]
        keep = np.ones(len(code), dtype=bool)
        keep[1:] = (code[1:] < _OTHER) | (code[1:] != code[:-1])
        code = code[keep]
        # After an edge the two characters before count as edges.
        one = code[:-1].copy()
        two = np.concatenate([[_EDGE], code[:-2]])
        two[one == _EDGE] = _EDGE
        total += np.bincount((two * _SIZE + one) * _SIZE + code[1:], minlength=_SIZE**3)
    return total


class Channel:
    """Decodes obfuscated tokens under a character trigram model."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(_SIZE, _SIZE, _SIZE).astype(np.float64)
        unigram = (c.sum(axis=(0, 1)) + 1) / (c.sum() + _SIZE)
        pair = c.sum(axis=0)
        bigram = (pair + 20 * unigram) / (pair.sum(axis=1, keepdims=True) + 20)
        self.cost = -np.log((c + 20 * bigram[None]) / (c.sum(axis=2, keepdims=True) + 20))
        self._memory: dict[str, str] = {}

    @staticmethod
    def _class(char: str) -> int:
        return ord(char) - 97 if "a" <= char <= "z" else _OTHER if char.isalpha() else _EDGE

    def lattice(self, token: str) -> Iterator[list[tuple[str, float]]]:
        """For each position, the strings it may stand for and what each costs in the channel."""
        i = 0
        while i < len(token):
            char, run = token[i], 1
            while i + run < len(token) and token[i + run] == char:
                run += 1
            if char.isalpha():
                once = [(char, 0.0 if run == 1 else 1.0)]
                yield once if run == 1 else once + [(char * 2, 0.0 if run == 2 else 1.0)]
                i += run
                continue
            arcs = [(x, 2.0) for x in LOOKS_LIKE.get(char, "")]
            if char in FILLERS or not char.isalnum():
                arcs.append(("", 1.0))
            arcs.append((char, 4.0 if 0 < i < len(token) - 1 else 2.0))
            yield arcs
            i += 1

    def restore(self, token: str) -> str:
        """The likeliest string behind a lower-cased token; long ones are not remembered."""
        if len(token) > 64:
            return self._viterbi(token)
        known = self._memory.get(token)
        if known is None:
            if len(self._memory) >= 100_000:
                self._memory.clear()
            known = self._memory[token] = self._viterbi(token)
        return known

    def _viterbi(self, token: str) -> str:
        cost = self.cost
        settled: list[str] = []
        best: dict[tuple[int, int], tuple[float, tuple]] = {(_EDGE, _EDGE): (0.0, ())}
        for arcs in self.lattice(token):
            following: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (so_far, path) in best.items():
                for string, price in arcs:
                    x, y, total = a, b, so_far + price
                    for char in string:
                        k = self._class(char)
                        total += cost[x, y, k]
                        x, y = (_EDGE, _EDGE) if k == _EDGE else (y, k)
                    old = following.get((x, y))
                    if old is None or total < old[0]:
                        following[x, y] = (total, (path, string))
            best = following
            if len(best) == 1:
                [(state, (so_far, path))] = best.items()
                settled.append(self._spelt(path))
                best = {state: (so_far, ())}
        _, path = min(((s + cost[a, b, _EDGE], p) for (a, b), (s, p) in best.items()), key=lambda x: x[0])
        return "".join(settled) + self._spelt(path)

    @staticmethod
    def _spelt(path: tuple) -> str:
        parts = []
        while path:
            path, string = path
            parts.append(string)
        return "".join(reversed(parts))

    def restored_tokens(self, text: str) -> str:
        """The restored forms of the obfuscated tokens of a lower-cased text, space-separated."""
        found = []
        for token in suspects(text):
            token = token.strip(".,;:?\"*%&#")
            if len(token) > 1 and (restored := self.restore(token)) != token:
                found.append(restored)
        return " ".join(found)


def suspects(text: str) -> Iterator[str]:
    """The tokens of a lower-cased text that show obfuscation, letters set apart as one."""
    at = 0
    for match in (*_SPACED.finditer(text), None):
        part = text[at : match.start() if match else len(text)]
        tokens = part.split()
        if at and tokens and not part[0].isspace():
            tokens[0] = tokens[0][1:]  # the sign after the last letter set apart
        yield from filter(_MARKED.search, tokens)
        if match:
            yield match.group()
            at = match.end()


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) for each word and each of its beginnings; not distinct."""
    words = Words(texts, _WORD_TABLE)
    length = words.end - words.start
    doc, feature = [words.doc], [mix64(words.hashes() + np.uint64(1))]
    for n in PREFIXES:
        long = np.flatnonzero(length > n)
        doc.append(words.doc[long])
        feature.append(mix64(words.span_hash(words.start[long], words.start[long] + n) + np.uint64(n)))
    return np.concatenate(doc), (np.concatenate(feature) & np.uint64((1 << FEATURE_BITS) - 1)).astype(np.int64)


#: Found in every lower-cased text, as bytes, that has a suspect token; € and £ have several bytes.
_HINT = re.compile(
    rb"[a-z\x80-\xff](?:[0-9@$!|+(<.\-_*~'^#=/\\]|\xe2\x82\xac|\xc2\xa3)+[a-z\x80-\xff]"
    rb"|(?:[0-9@$|+(<]|\xe2\x82\xac|\xc2\xa3)[a-z\x80-\xff]|([a-z])\1\1|([\x80-\xff]{2,4})\2\2"
    rb"|(?:[ .\-_*~'^#=/\\](?:[a-z]|[\x80-\xff]{2,4})){2}[ .\-_*~'^#=/\\]"
    rb"|[a-z\x80-\xff][^a-z\s\x1c-\x1f\x80-\xff0-9@$!|+(<]*+(?:[0-9@$!|+(<]|\xe2\x82\xac|\xc2\xa3)[^a-z\s\x1c-\x1f\x80-\xff]*+(?:[\s\x1c-\x1f\x80-\xff]|\Z)"
)


def readable(texts: list[bytes], channel: Channel) -> list[bytes]:
    """Lower-cased texts, each followed by the restored forms of its obfuscated tokens."""
    out = []
    for raw in texts:
        low = raw.translate(LOWER)
        if _HINT.search(low):
            extra = channel.restored_tokens(low.decode("utf-8", "replace"))
            if extra:
                low = low + b" " + extra.encode()
        out.append(low)
    return out


def held_out(doc_id: str) -> Column:
    """Rows that are never learned from; a row without an id is one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def character_model(docs: DataFrame) -> Channel:
    """The trigram model of all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SIZE**3, dtype=np.int64)
        for batch in batches:
            total += trigram_counts(utf8_list(batch.column(0)))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_SIZE**3, dtype=np.int64)
    for gram, n in rows:
        counts[gram] = n
    return Channel(counts)


def _presence(texts: list[bytes], channel: Channel, wanted: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first document, document, feature) of the distinct wanted features, group by group."""
    for begin, end in groups(texts):
        doc, feature = _features(readable(texts[begin:end], channel))
        if wanted is not None:
            keep = wanted[feature]
            doc, feature = doc[keep], feature[keep]
        pair = np.unique(doc << FEATURE_BITS | feature)
        yield begin, pair >> FEATURE_BITS, pair & ((1 << FEATURE_BITS) - 1)


class Model:
    def __init__(self, bias: float, weights: dict[int, float], channel: Channel):
        self.bias, self.channel = bias, channel
        self.wanted = np.zeros(1 << FEATURE_BITS, dtype=bool)
        self.weight = np.zeros(1 << FEATURE_BITS, dtype=np.float32)
        for f, w in weights.items():
            self.wanted[f], self.weight[f] = True, w

    def scores(self, texts: list[bytes]) -> np.ndarray:
        total = np.full(len(texts), self.bias)
        for begin, doc, feature in _presence(texts, self.channel, self.wanted):
            np.add.at(total, begin + doc, self.weight[feature].astype(np.float64))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _logistic(rows: np.ndarray, columns: np.ndarray, y: np.ndarray, copies: np.ndarray, width: int) -> tuple[float, np.ndarray]:
    """L2-regularised logistic regression on binary features by accelerated gradient descent;
    ``copies`` says how often each row stands."""
    size, n = len(y), copies.sum()
    w, b, v, u = np.zeros(width), 0.0, np.zeros(width), 0.0
    share = (y * copies).sum() / n
    weight = copies * np.where(y > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    rate = 2.0
    degree = np.maximum(np.bincount(columns, weights=copies[rows].astype(np.float64), minlength=width) / n, 1e-3)
    for _ in range(1500):
        z = u + np.bincount(rows, weights=v[columns], minlength=size)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight / n
        gw = np.bincount(columns, weights=g[rows], minlength=width) + 1e-5 * v
        new_w, new_b = v - rate * gw / np.sqrt(degree), u - rate * g.sum()
        v, u = new_w + 0.8 * (new_w - w), new_b + 0.8 * (new_b - b)
        w, b = new_w, new_b
    return b, w


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the labelled rows that are not held out."""
    small_batches(docs.sparkSession)
    channel = character_model(docs)
    share = docs.sparkSession.sparkContext.broadcast(channel)
    y = labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id")).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    y = stored(y.withColumn("h", F.xxhash64("doc_id")), "labels")
    chosen_rows = None
    half = sample_rows // 2
    labelled = {k: n for k, n in y.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    for k, n in labelled.items():
        # The share that surely holds enough rows, so that few are sorted; then the first of them.
        share_of = min(1.0, 2.0 * half / n + 100.0 / n)
        part = y.where((F.col("toxic") == k) & (F.pmod("h", F.lit(1 << 20)) < int(share_of * (1 << 20)) + 1)).orderBy("h", "doc_id").limit(half)
        chosen_rows = part if chosen_rows is None else chosen_rows.unionByName(part)
    if chosen_rows is None:
        return Model(-30.0, {}, channel)
    # At most ``sample_rows`` narrow rows: texts are scanned where they lie, not shuffled.
    chosen_rows = stored(chosen_rows.select("doc_id", "toxic"), "sample")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen_rows), "doc_id").select("doc_id", "text", "toxic")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Document counts of each feature by class; feature -1 has the documents."""
        total = np.zeros((2, 1 << FEATURE_BITS), dtype=np.int64)
        n = np.zeros(2, dtype=np.int64)
        for batch in batches:
            toxic = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            n += np.bincount(toxic, minlength=2)[:2]
            for begin, doc, feature in _presence(utf8_list(batch.column(1)), share.value, None):
                kind = toxic[begin + doc]
                for k in (0, 1):
                    total[k] += np.bincount(feature[kind == k], minlength=1 << FEATURE_BITS)
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1).astype(np.int32)), *(pa.array(np.append(total[k][at], n[k])) for k in (0, 1))], names=["feature", "clean", "toxic"]
        )

    # The features of a class must occur in several of its documents; the driver gets SELECTED of them.
    counts = rows.mapInArrow(count, "feature int, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = stored(counts, "features")
    sums = counts.where("feature = -1").select("clean", "toxic").first()
    n_clean, n_toxic = (sums[0], sums[1]) if sums else (0, 0)
    if not n_clean or not n_toxic:
        return Model(-30.0 if not n_toxic else 30.0, {}, channel)
    p, q = (F.col("toxic") + 0.5) / (n_toxic + 1.0), (F.col("clean") + 0.5) / (n_clean + 1.0)
    gain = F.abs(F.log(p / q)) * F.sqrt(F.greatest(p, q))
    enough = (F.col("feature") >= 0) & (F.col("toxic") + F.col("clean") >= 4) & (F.col("toxic") / n_toxic > 3 * F.col("clean") / n_clean)
    chosen = [r[0] for r in counts.where(enough).orderBy(gain.desc(), "feature").limit(SELECTED).select("feature").collect()]
    if not chosen:
        return Model(float(np.log(labelled[1] / labelled[0])), {}, channel)
    place = np.full(1 << FEATURE_BITS, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8_list(batch.column(1))
            packed = [b""] * len(texts)
            for begin, doc, feature in _presence(texts, share.value, place >= 0):
                ends = np.searchsorted(doc, np.arange(doc[-1] + 2)) if len(doc) else np.empty(0, np.int64)
                for d, (x, y) in enumerate(itertools.pairwise(ends)):
                    packed[begin + d] = np.sort(place[feature[x:y]]).astype("<i2").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(2)], names=["features", "toxic"])

    # Equal rows are one with a count; where ids repeat over more texts than were sampled, a
    # share of the rows is drawn by hash, so that what reaches the driver is bounded.
    patterns = rows.mapInArrow(gather, "features binary, toxic int").groupBy("features", "toxic").agg(F.count("*").alias("copies"))
    patterns = stored(patterns, "patterns")
    share_of = sample_rows / max(1, patterns.count())
    if share_of < 1:
        patterns = patterns.where(F.pmod(F.xxhash64("features", "toxic"), F.lit(1 << 20)) < int(share_of * (1 << 20)))
    got = sorted((bytes(r[0]), r[1], r[2]) for r in patterns.collect())
    lists = [np.frombuffer(r[0], "<i2").astype(np.int64) for r in got]
    at = np.repeat(np.arange(len(got)), [len(x) for x in lists])
    columns = np.concatenate([np.empty(0, np.int64), *lists])
    y, copies = (np.array([r[k] for r in got], dtype=np.float64) for k in (1, 2))
    bias, w = _logistic(at, columns, y, copies, max(1, len(chosen)))
    return Model(bias, {f: float(w[i]) for i, f in enumerate(chosen)}, channel)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for every row."""
    small_batches(docs.sparkSession)
    share = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(share.value.scores(utf8_list(batch.column(1))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    out = score(docs, model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
