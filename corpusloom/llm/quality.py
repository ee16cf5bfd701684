"""Quality classifier from weak labels.

Nine heuristic labellers vote good, bad or abstain on each document. The counts of vote
patterns (at most 3 ** 9, whatever the corpus) are all that expectation-maximisation needs:
it estimates each labeller's accuracy and the share of good documents over all rows, and
gives each pattern a posterior. Posterior labels of a bounded sample (SAMPLE_ROWS for each
side, by hash order) train a linear scorer on hashed word shapes, which then scores every
document. Gold labels are not used.

Edge cases: null and blank texts have no words, no votes and score 0; with an empty table or without
both classes in the sample, the posterior of the votes is the score; repeated rows get equal
scores; very long texts are scored whole; ``reject`` keeps all columns of its input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textkit import Words, groups, mix64, small_batches, stored, table, utf8_list

BUCKETS = 512
SAMPLE_ROWS = 6_000
VARIETY_WORDS = 500
REJECT_BELOW = 0.2
LABELLERS = ("symbols", "odd_bytes", "shouting", "exclaiming", "repeating", "variety", "separators", "rhythm", "prose")

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_ODD = np.zeros(256, dtype=bool)
_ODD[[ord(c) for c in "%*&$#~^=_<>{}[]\\"]] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".?!"]] = True
#: Class of a byte in a word's shape.
_KIND = np.full(256, 4, dtype=np.uint64)
_KIND[97:123] = 0
_KIND[128:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[ord(c) for c in ".,;:?"]] = 3
_KIND[ord("!")] = 5
_KIND[ord("|")] = 6


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Votes (documents, labellers) in 1, 0, -1 and shape features (documents, BUCKETS)."""
    n_docs = len(texts)
    w = Words(texts)
    n = np.bincount(w.doc, minlength=n_docs)
    length = w.end - w.start
    first, last = w.buffer[w.start], w.buffer[w.end - 1]
    before_last = w.buffer[np.maximum(w.end - 2, w.start)]

    def share(flag: np.ndarray) -> np.ndarray:
        return _ratio(np.bincount(w.doc, weights=flag, minlength=n_docs), n)

    def total(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[w.buffer])])
        begin = np.concatenate([[0], w.doc_end[:-1]])
        return sums[w.doc_end] - sums[begin]

    hashes = w.hashes()
    # Variety is measured in windows of so many words, so that one rule holds at every length.
    window = (np.arange(len(w.doc)) - (np.cumsum(n) - n)[w.doc]) // VARIETY_WORDS
    order = np.lexsort((hashes, window, w.doc))
    fresh = np.ones(len(order), dtype=bool)
    for x in (w.doc[order], window[order], hashes[order]):
        fresh[1:] &= x[1:] == x[:-1]
    fresh[1:] = ~fresh[1:]
    distinct = np.bincount(w.doc[order][fresh], minlength=n_docs)
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (w.doc[1:] == w.doc[:-1])

    begin = np.concatenate([[0], w.doc_end[:-1]])
    size = w.doc_end - 1 - begin
    blanks = total(_BLANK) - 1
    strange = _ratio(size - blanks - total(_LETTER | _DIGIT), np.maximum(size - blanks, 1))
    symbols = share(_ODD[last] & (length > 1))
    capitals = _ratio(total(_UPPER), total(_LETTER))
    exclaim = share((last == 33) & (before_last == 33))
    repeat = share(again)
    variety = _ratio(distinct, n)
    bars = share((length == 1) & ~_LETTER[first] & ~((first >= 48) & (first < 58)))
    short = share((length <= 3) & _LETTER[first])
    ends = share(_STOP[last])

    votes = np.full((n_docs, len(LABELLERS)), -1, dtype=np.int8)

    def vote(name: str, good: np.ndarray, bad: np.ndarray) -> None:
        column = votes[:, LABELLERS.index(name)]
        column[good & (n > 0)] = 1
        column[bad & (n > 0)] = 0

    prose = (symbols < 0.03) & ((capitals < 0.2) | (n < 10)) & (exclaim < 0.03) & (bars < 0.02) & ((repeat < 0.1) | (n < 10)) & ((strange < 0.12) | (n < 10))
    never = np.zeros(n_docs, dtype=bool)
    vote("symbols", never, symbols > 0.15)
    vote("odd_bytes", never, (strange > 0.15) & (n >= 10))
    vote("shouting", never, (capitals > 0.35) & (n >= 10))
    vote("exclaiming", never, exclaim > 0.1)
    vote("repeating", never, repeat > 0.25)
    vote("variety", never, (variety < 0.35) & (n >= 20))
    vote("separators", never, bars > 0.12)
    vote("rhythm", (short > 0.1) & (short < 0.8) & (ends < 0.5), (short < 0.03) & (n >= 20))
    vote("prose", prose & (variety > 0.3), never)

    shape = np.minimum(length, 12).astype(np.uint64)
    for part in (_KIND[first], _KIND[before_last], _KIND[last], again.astype(np.uint64)):
        shape = shape * np.uint64(8) + part
    bucket = (mix64(shape) % np.uint64(BUCKETS - 4)).astype(np.int64) + 4
    counts = np.bincount(w.doc * BUCKETS + bucket, minlength=n_docs * BUCKETS).reshape(n_docs, BUCKETS)
    features = np.sqrt(counts / np.maximum(n, 1)[:, None]).astype(np.float32)
    features[:, 0], features[:, 1] = variety, capitals
    features[:, 2], features[:, 3] = n < 20, n < 3
    return votes, features


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each vote pattern, each labeller's accuracy, the share of good.

    Each labeller has its own chances of voting good, bad or nothing given the true class
    (two coins, as its two kinds of error differ). It starts as likelier to be right than
    wrong and never gets a vote for bad that is commoner among good documents, so the classes
    keep their meaning. The accuracy is that of the votes it casts.
    """
    seen = np.stack([patterns == v for v in (-1, 0, 1)]).astype(np.float64)  # vote, pattern, labeller
    chance = np.empty((2, 3, patterns.shape[1]))  # class, vote, labeller
    chance[0], chance[1] = np.array([[0.4], [0.35], [0.25]]), np.array([[0.3], [0.02], [0.68]])
    good = 0.85
    posterior = np.full(len(patterns), good)
    for _ in range(rounds):
        like = [np.log(share) + sum(seen[v] @ np.log(chance[y, v]) for v in range(3)) for y, share in ((0, 1 - good), (1, good))]
        new = 1 / (1 + np.exp(np.clip(like[0] - like[1], -500, 500)))
        for y, weight in ((0, counts * (1 - new)), (1, counts * new)):
            votes = np.stack([weight @ seen[v] for v in range(3)])
            chance[y] = (votes + np.array([[1.0], [0.5], [0.5]])) / (weight.sum() + 2)
        wrong = chance[1, 1] > chance[0, 1]
        chance[1, 1][wrong] = chance[0, 1][wrong]
        good = float(np.clip((counts @ new + 9) / (counts.sum() + 10), 0.05, 0.995))
        if np.abs(new - posterior).max(initial=0) < 1e-7:
            break
        posterior = new
    right = good * chance[1, 2] + (1 - good) * chance[0, 1]
    cast = good * (chance[1, 1] + chance[1, 2]) + (1 - good) * (chance[0, 1] + chance[0, 2])
    return posterior, right / np.maximum(cast, 1e-12), good


def _encode(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) + 1) @ (3 ** np.arange(votes.shape[1]))


def _decode(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3) - 1


class Scorer:
    def __init__(self, posterior: dict[int, float], weights: np.ndarray | None, bias: float):
        self.posterior, self.weights, self.bias = posterior, weights, bias

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(score, posterior of the votes) of each text."""
        score, weak = np.zeros(len(texts)), np.zeros(len(texts))
        for begin, end in groups(texts):
            votes, features = describe(texts[begin:end])
            weak[begin:end] = [self.posterior.get(int(c), 0.5) for c in _encode(votes)]
            if self.weights is None:
                score[begin:end] = weak[begin:end]
            else:
                # Summed row by row: a matrix product depends on which rows come together.
                total = (features.astype(np.float64) * self.weights).sum(axis=1) + self.bias
                score[begin:end] = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
            blank = np.array([not t.strip() for t in texts[begin:end]], dtype=bool)
            score[begin:end][blank] = weak[begin:end][blank] = 0.0
        return score, weak


def _fit(features: np.ndarray, target: np.ndarray, copies: np.ndarray, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient descent; ``copies`` says how
    often each row stands."""
    share = (copies / copies.sum()).astype(np.float32)
    scale = np.sqrt(share @ features**2) + 0.02
    x = features / scale
    w, b, v, u = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0
    rate = 4.0 / max(1.0, float(share @ (x**2).sum(axis=1)))
    for _ in range(rounds):
        g = (1 / (1 + np.exp(-np.clip(x @ v + u, -30, 30))) - target).astype(np.float32) * share
        new_w, new_b = v - rate * (g @ x + 1e-4 * v), u - rate * float(g.sum())
        v, u = new_w + 0.9 * (new_w - w), new_b + 0.9 * (new_b - b)
        w, b = new_w, new_b
    return w / scale, b


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[Scorer, dict[str, float]]:
    """The scorer, and the estimated accuracy of each labeller, from columns doc_id and text."""
    spark = docs.sparkSession
    small_batches(spark)
    total = docs.count()
    rate = min(1.0, 16 * sample_rows / max(total, 1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, draw = utf8_list(batch.column(1)), batch.column(0).to_numpy(zero_copy_only=False)
            for begin, end in groups(texts):
                votes, features = describe(texts[begin:end])
                kept = [f.tobytes() if d < rate else None for f, d in zip(features, draw[begin:end], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(_encode(votes).astype(np.int32)), pa.array(draw[begin:end]), pa.array(kept, pa.binary())], names=["pattern", "draw", "features"])

    drawn = (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)) / float(1 << 52)).alias("draw")
    voted = stored(docs.select(drawn, "text").mapInArrow(run, "pattern int, draw double, features binary"), "votes")
    rows = sorted(voted.groupBy("pattern").count().collect())
    codes, counts = np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.float64)
    if not len(rows):
        return Scorer({}, None, 0.0), dict.fromkeys(LABELLERS, 0.5)
    posterior, accuracy, _ = expectation_maximisation(_decode(codes), counts)
    named = dict(zip(LABELLERS, map(float, accuracy), strict=True))
    by_pattern = {int(c): float(p) for c, p in zip(codes, posterior, strict=True)}
    given = spark.createDataFrame([(k, v) for k, v in by_pattern.items()], "pattern int, p double")
    sample = voted.where("features is not null").join(F.broadcast(given), "pattern")
    # Of each side the rows with the smallest draws: their bound is found on draws alone, and
    # rows of one draw, which are repeats, are one with a count. So the sample is bounded and
    # the same however the rows are dealt out.
    picked = []
    for good in (True, False):
        side = sample.where((F.col("p") >= 0.5) == good)
        last = side.select("draw").distinct().orderBy("draw").limit(sample_rows).agg(F.max("draw")).first()[0]
        if last is None:
            return Scorer(by_pattern, None, 0.0), named
        picked += side.where(F.col("draw") <= last).groupBy("draw", "features", "p").count().collect()
    picked.sort(key=lambda r: (r[0], bytes(r[1]), r[2]))
    features = np.stack([np.frombuffer(r[1], dtype=np.float32) for r in picked])
    target, copies = (np.array([r[k] for r in picked], dtype=np.float64) for k in (2, 3))
    weights, bias = _fit(features, target, copies)
    return Scorer(by_pattern, weights, bias), named


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``docs`` with the columns score and weak_posterior; their names must be free."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(scorer)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("weak_posterior", T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, weak = shared.value.scores(utf8_list(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(points), pa.array(weak)], names=[*batch.schema.names, "score", "weak_posterior"])

    return docs.mapInArrow(run, schema)


def accepted() -> Column:
    """A document goes only if the scorer is sure that it's bad and the votes agree."""
    return (F.col("score") >= REJECT_BELOW) | (F.col("weak_posterior") >= 0.5)


def reject(docs: DataFrame) -> DataFrame:
    """The accepted documents, with their own columns only."""
    scorer, _ = train(docs.select("doc_id", "text"))
    inner = docs.toDF(*(f"c{i}_{c}" if c != "text" else c for i, c in enumerate(docs.columns)))
    kept = score(inner, scorer).where(accepted()).drop("score", "weak_posterior")
    return kept.toDF(*docs.columns)


def op6_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    scorer, _ = train(docs)
    out = score(docs, scorer)
    return out.select("doc_id", "score", "weak_posterior", accepted().cast("int").alias("predicted"))
