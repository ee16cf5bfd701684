"""Functions that need Python: Arrow-batched, never row by row from the JVM."""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections.abc import Iterable
from html.parser import HTMLParser
from urllib.parse import urljoin

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:  # Python's own MD5 takes half the time of hashlib's on single values.
    from _md5 import md5
except ImportError:
    from hashlib import md5

BITS = 128
#: N-grams whose bits are counted at once, and whose MD5 values are computed at once.
_GRAMS, _AT_ONCE = 1 << 15, 1 << 13


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch can hold, so that a run of long texts fits a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")


_PRINT = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())])
_STRINGS = T.ArrayType(T.StringType())
_PAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "content", "time")] + [T.StructField("links", _STRINGS)])
_PAIRS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("question", "answer")]))


@F.pandas_udf(T.StringType())
def clean_text(texts: pd.Series) -> pd.Series:
    """Compatibility-normalised, whitespace collapsed and trimmed; null is empty."""
    return texts.map(lambda t: " ".join(unicodedata.normalize("NFKC", t).split()) if t else "")


# MD5's constants: rotations and added values of its 64 steps, and the state that it starts from.
_TURNS = [t for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in four * 4]
_ADDED = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_short(line: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MD5 values, as rows of 16 bytes, of slices of ``line`` of at most 55 bytes: each is one
    block of MD5, so a step is taken for all slices at once."""
    sizes = (ends - starts).astype(np.uint8)[:, None]
    block = np.lib.stride_tricks.sliding_window_view(np.frombuffer(line + bytes(64), dtype=np.uint8), 56)[starts]
    block *= np.arange(56, dtype=np.uint8) < sizes
    block[np.arange(len(block)), sizes[:, 0]] = 0x80
    words = [*np.ascontiguousarray(block.view("<u4").T), sizes[:, 0].astype(np.uint32) * np.uint32(8), None]
    a, b, c, d = (np.full(len(starts), v, dtype=np.uint32) for v in _START)
    f, g = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 32:  # the second 16 steps choose as the first do, between other values
            x, y, z = (b, c, d) if i < 16 else (d, b, c)
            np.bitwise_xor(y, z, out=f)
            np.bitwise_and(f, x, out=f)
            np.bitwise_xor(f, z, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.bitwise_not(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        word = words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16]
        if word is not None:  # the last word of so short a block is 0
            f += word
        f += a
        f += _ADDED[i]
        np.left_shift(f, _TURNS[i], out=g)
        np.right_shift(f, 32 - _TURNS[i], out=f)
        f |= g
        f += b
        a, b, c, d, f = d, f, b, c, a
    out = np.stack([x + np.uint32(v) for x, v in zip((a, b, c, d), _START, strict=True)], axis=1)
    return out.astype("<u4", copy=False).view(np.uint8)


def _md5(line: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MD5 values of slices of ``line``, as rows of 16 bytes."""
    out = np.empty((len(starts), 16), dtype=np.uint8)
    short = ends - starts <= 55
    which = np.flatnonzero(short)
    for at in range(0, len(which), _AT_ONCE):
        some = which[at : at + _AT_ONCE]
        out[some] = _md5_short(line, starts[some], ends[some])
    for i in np.flatnonzero(~short):
        out[i] = np.frombuffer(md5(line[starts[i] : ends[i]]).digest(), dtype=np.uint8)
    return out


def fingerprints(texts: Iterable[str | None], width: int = 3) -> list[tuple[int, int]]:
    """128-bit SimHash over word n-grams (the words themselves if fewer) as two signed longs:
    bit i is set if it is set in most of the n-grams' MD5 values. A text without words has 0."""
    texts = list(texts)
    votes, total = np.zeros((len(texts), BITS), dtype=np.int64), np.zeros((len(texts), 1), dtype=np.int64)
    lines: list[bytes] = []
    parts: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = held = 0

    def count() -> None:
        if parts:
            digests = _md5(b"".join(lines), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]))
            at = 0
            for k, starts, _ in parts:
                votes[k] += np.unpackbits(digests[at : at + len(starts)], axis=1).sum(axis=0, dtype=np.uint32)
                at += len(starts)
        lines.clear()
        parts.clear()

    for k, text in enumerate(texts):
        words = (text or "").lower().split()
        if not words:
            continue
        line = " ".join(words).encode()
        blanks = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
        # No word holds a blank, so each n-gram is a slice of the line.
        edges = np.concatenate([[-1], blanks, [len(line)]])
        starts, ends = edges[:-1] + 1, edges[1:]
        if len(words) >= width:
            starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
        total[k] = len(ends)
        for at in range(0, len(ends), _GRAMS):
            s, e = starts[at : at + _GRAMS], ends[at : at + _GRAMS]
            lines.append(line[s[0] : e[-1]])
            parts.append((k, s - s[0] + size, e - s[0] + size))
            size, held = size + len(lines[-1]), held + len(s)
            if held >= _GRAMS:
                count()
                size = held = 0
    count()
    pairs = np.packbits(2 * votes > total, axis=1).view(">i8")
    return [(int(high), int(low)) for high, low in pairs]


def fingerprint(text: str | None, width: int = 3) -> tuple[int, int]:
    """The SimHash of one text."""
    return fingerprints([text], width)[0]


@F.pandas_udf(_PRINT)
def simhash128(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(fingerprints(texts), columns=["hi", "lo"], dtype="int64")


# What is taken out of an article's content.
UNWANTED_TAGS = frozenset(("script", "style", "nav", "form", "select", "option", "button", "input", "label"))
UNWANTED_CLASSES = frozenset(("ad", "advertisement", "social-share", "related", "comments", "wp-block-embed"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Page(HTMLParser):
    """Collects the title, links, and the markup of the first article (or content block)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.links: list[str] = []
        self.title: list[str] = []
        self.when = ""
        self.content: list[str] = []
        self._stack: list[tuple[str, bool, bool]] = []
        self._done = False

    def _state(self) -> tuple[bool, bool]:
        return self._stack[-1][1:] if self._stack else (False, False)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        have = {k: v or "" for k, v in attrs}
        classes = set(have.get("class", "").split())
        inside, skipped = self._state()
        if tag == "a" and have.get("href"):
            self.links.append(have["href"])
        if tag == "time" and not self.when:
            self.when = have.get("datetime", "")
        starts = not inside and not self._done and (tag == "article" or tag == "div" and "content" in classes)
        skip = skipped or (inside and (tag in UNWANTED_TAGS or bool(classes & UNWANTED_CLASSES)))
        if (inside or starts) and not skip:
            self.content.append(self.get_starttag_text() or "")
        if tag not in VOID:
            self._stack.append((tag, inside or starts, skip))

    def handle_endtag(self, tag: str) -> None:
        if not any(t == tag for t, _, _ in self._stack):
            return
        while self._stack:
            name, inside, skip = self._stack.pop()
            if inside and not skip:
                self.content.append(f"</{name}>")
            if inside and not self._state()[0]:
                self._done = True
            if name == tag:
                break

    def _text(self, data: str) -> None:
        inside, skip = self._state()
        if any(t == "h1" for t, _, _ in self._stack):
            self.title.append(data)
        if inside and not skip:
            self.content.append(data)

    handle_data = _text

    def handle_entityref(self, name: str) -> None:
        self._text(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self._text(f"&#{name};")


def parse_page(html: str | None) -> tuple[str, str, str, list[str]]:
    """(title markup, content markup, time attribute, links)."""
    page = _Page()
    page.feed(html or "")
    page.close()
    return "".join(page.title), "".join(page.content), page.when, page.links


@F.pandas_udf(_PAGE)
def html_page(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_page(h) for h in html], columns=["title", "content", "time", "links"])


@F.pandas_udf(_STRINGS)
def absolute_links(base: pd.Series, links: pd.Series) -> pd.Series:
    return pd.Series([[urljoin(b or "", x) for x in (found if found is not None else [])] for b, found in zip(base, links, strict=True)])


_STRING = r'"((?:[^"\\]|\\.)*)"'
_PAIR = re.compile(rf'\{{\s*"question"\s*:\s*{_STRING}\s*,\s*"answer"\s*:\s*{_STRING}\s*\}}', re.S)


def _loaded(text: str) -> object:
    try:
        return json.loads(text)
    except ValueError:
        return None


def parse_pairs(response: str | None) -> list[tuple[str, str]]:
    """The (question, answer) pairs of a generator's reply.

    In order: the widest bracketed part as an array; the whole as an array, a single pair, or
    an object that holds an array; else every complete pair found in broken JSON.
    """
    cleaned = re.sub(r"```(?:json)?", "", response or "").strip()
    if not cleaned:
        return []
    first, last = cleaned.find("["), cleaned.rfind("]")
    found = _loaded(cleaned[first : last + 1]) if 0 <= first < last else None
    if not isinstance(found, list):
        whole = _loaded(cleaned)
        if isinstance(whole, dict):
            whole = [whole] if {"question", "answer"} <= whole.keys() else next((v for v in whole.values() if isinstance(v, list)), None)
        found = whole if isinstance(whole, list) else None
    if found is None:
        found = []
        for q, a in _PAIR.findall(cleaned):
            pair = _loaded(f'["{q}", "{a}"]')
            if pair:
                found.append({"question": pair[0], "answer": pair[1]})
    return [(str(x["question"]).strip(), str(x["answer"]).strip()) for x in found if isinstance(x, dict) and {"question", "answer"} <= x.keys()]


@F.pandas_udf(_PAIRS)
def qa_pairs(responses: pd.Series) -> pd.Series:
    return responses.map(lambda r: [{"question": q, "answer": a} for q, a in parse_pairs(r)])


# Frequent words by language.
STOP_WORDS = {
    "en": "the of and to in is that it for was on with as be by this are from at which".split(),
    "fr": "le la les de des et un une que est en pour dans qui sur au avec ce pas".split(),
    "de": "der die das und ist von den mit ein eine nicht zu dem auch für sich auf im".split(),
    "es": "el los las que y en un una por con para es del se como su al más".split(),
}
_STOPS = {k: frozenset(v) for k, v in STOP_WORDS.items()}


def language_of(text: str | None) -> str:
    """Language by frequent words of the first 2000 characters; short or unclear texts are en."""
    if not text or len(text) < 50:
        return "en"
    words = re.findall(r"[^\W\d_]+", text[:2000].lower())
    score = {k: sum(w in s for w in words) for k, s in _STOPS.items()}
    best = max(score, key=lambda k: (score[k], k == "en"))
    return best if score[best] else "en"


@F.pandas_udf(T.StringType())
def detect_language(texts: pd.Series) -> pd.Series:
    return texts.map(language_of)
