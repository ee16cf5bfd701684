"""Languages by profiles of character n-grams.

A profile is the commonest n-grams of a language's texts with their counts, learned from texts
whose language is known. A text's score for a language is the sum of its n-grams' log
probabilities there, over the n-grams that any profile has; an n-gram that a profile lacks counts
as seen less than once. Weights are whole thousandths, so scores don't depend on the order of sums.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .python import small_batches

SHORTEST, READ_CHARS = 50, 2000
LONGEST_GRAM, PROFILE_SIZE = 4, 300
MOST_LANGUAGES = 500
_HELD = 200_000


def grams(text: str | None) -> Counter[str]:
    """The n-grams of the first READ_CHARS characters: words in lower case, a blank on each side."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "")[:READ_CHARS].lower())
    t = f" {' '.join(letters.split())} "
    return Counter(t[i : i + n] for n in range(1, LONGEST_GRAM + 1) for i in range(len(t) - n + 1)) if t.strip() else Counter()


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _spelt(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of many texts as ``grams`` reads them, and the number of each one's text."""
    read = [f" {(t or '')[:READ_CHARS].lower()} " for t in texts]
    points = np.frombuffer("".join(read).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    doc = np.repeat(np.arange(len(read)), [len(t) for t in read])
    points = np.where(_letters()[points], points, 32)
    blank = points == 32
    again = np.zeros(len(points), dtype=bool)
    again[1:] = blank[1:] & blank[:-1] & (doc[1:] == doc[:-1])
    points, doc = points[~again], doc[~again]
    some = np.bincount(doc, minlength=len(read)) > 1  # a text without letters is one blank
    return points[some[doc]], doc[some[doc]]


def _windows(ids: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Each window of ``n`` ids below 65,536 in one text as one number, and its text."""
    size = max(len(ids) - n + 1, 0)
    codes = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        codes = codes << np.uint64(16) | ids[k : k + size].astype(np.uint64)
    whole = doc[:size] == doc[n - 1 : n - 1 + size]
    return codes[whole], doc[:size][whole]


def counted_grams(texts: list[str | None]) -> dict[str, int]:
    """The sum of ``grams`` over many texts."""
    points, doc = _spelt(texts)
    alphabet, ids = np.unique(points, return_inverse=True)
    if len(alphabet) > 1 << 16:
        return sum(map(grams, texts), Counter())
    out: dict[str, int] = {}
    for n in range(1, LONGEST_GRAM + 1):
        codes, counts = np.unique(_windows(ids, doc, n)[0], return_counts=True)
        places = codes[:, None] >> (np.uint64(16) * np.arange(n - 1, -1, -1, dtype=np.uint64)) & np.uint64(0xFFFF)
        found = alphabet[places.astype(np.int64)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        out |= zip((found[i : i + n] for i in range(0, len(found), n)), counts.tolist(), strict=True)
    return out


def profiles(docs: DataFrame, language: str, text: str, size: int = PROFILE_SIZE) -> DataFrame:
    """lang, gram, n and rank (1 for the commonest, equal counts by gram) of the ``size`` commonest
    n-grams of each language. Rows with a null language or a blank text have no part."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter[str]] = {}

        def frame() -> pd.DataFrame:
            return pd.DataFrame([(lang, g, n) for lang, c in held.items() for g, n in c.items()], columns=["lang", "gram", "n"])

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                held.setdefault(lang, Counter()).update(counted_grams(list(texts)))
            if sum(map(len, held.values())) > _HELD:
                yield frame()
                held = {}
        yield frame()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(language).alias("lang"), F.substring(F.col(text), 1, READ_CHARS).alias("text")).where("lang is not null")
    counted = rows.mapInPandas(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return counted.withColumn("rank", rank).where(F.col("rank") <= size)


class Detector:
    """Profiles as weights: at most PROFILE_SIZE n-grams of each of MOST_LANGUAGES languages."""

    def __init__(self, found: DataFrame):
        table = found.select("lang", "gram", "n").limit(MOST_LANGUAGES * PROFILE_SIZE + 1).collect()
        if len(table) > MOST_LANGUAGES * PROFILE_SIZE:
            raise ValueError(f"profiles of more than {MOST_LANGUAGES} languages")
        counts: dict[str, dict[str, int]] = {}
        for r in table:
            counts.setdefault(r.lang, {})[r.gram] = r.n
        #: English first, then by name: the first of those with the best score is taken.
        self.languages = sorted(counts, key=lambda x: (x != "en", x))
        known = {g for c in counts.values() for g in c}
        sizes = {x: sum(c.values()) + len(c) for x, c in counts.items()}
        self.weights = {g: [math.floor(1000 * math.log((counts[x].get(g, 0) + 1) / sizes[x]) + 0.5) for x in self.languages] for g in known}

    def of(self, text: str | None) -> str:
        """The language of a text; ``en`` for a short one and where no n-gram is known."""
        if not text or len(text) < SHORTEST or not self.languages:
            return "en"
        scores = [0] * len(self.languages)
        seen = False
        for gram, n in grams(text).items():
            for i, w in enumerate(self.weights.get(gram, ())):
                scores[i] += n * w
                seen = True
        return self.languages[max(range(len(scores)), key=scores.__getitem__)] if seen else "en"

    def of_all(self, texts: list[str | None]) -> list[str]:
        """``of`` for many texts at once."""
        alphabet = sorted({c for g in self.weights for c in g})
        if not self.languages or len(alphabet) >= 1 << 16:
            return [self.of(t) for t in texts]
        ids = np.zeros(0x110000, dtype=np.int64)  # 0: in no known n-gram
        ids[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        points, doc = _spelt(texts)
        scores, seen = np.zeros((len(texts), len(self.languages)), dtype=np.int64), np.zeros(len(texts), dtype=bool)
        for n in range(1, LONGEST_GRAM + 1):
            known = sorted((sum(int(ids[ord(c)]) << 16 * (n - 1 - k) for k, c in enumerate(g)), w) for g, w in self.weights.items() if len(g) == n)
            if known:
                table, weights = np.array([k for k, _ in known], dtype=np.uint64), np.array([w for _, w in known])
                codes, at = _windows(ids[points], doc, n)
                places = np.minimum(np.searchsorted(table, codes), len(table) - 1)
                hit = table[places] == codes
                for i in range(len(self.languages)):
                    # Sums of whole thousandths below 2 ** 53, so exact in doubles.
                    scores[:, i] += np.bincount(at[hit], weights=weights[places[hit], i], minlength=len(texts)).astype(np.int64)
                seen[at[hit]] = True
        best = scores.argmax(axis=1)
        return [self.languages[b] if s and t and len(t) >= SHORTEST else "en" for t, b, s in zip(texts, best, seen, strict=True)]

    def detect(self, text: Column) -> Column:
        @F.pandas_udf(T.StringType())
        def language(texts: pd.Series) -> pd.Series:
            return pd.Series(self.of_all([t if isinstance(t, str) else None for t in texts]), dtype=object)

        # A short text is told by its whole length, and no more than READ_CHARS of any is sent.
        return F.when(F.length(text) >= SHORTEST, language(F.substring(text, 1, READ_CHARS))).otherwise("en")
