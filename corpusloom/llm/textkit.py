"""Vectorised byte-level text primitives and small Spark helpers shared by the operators.

Words are found on the UTF-8 bytes of many documents at once, and hashed with a
prefix-sum polynomial, so that no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..functions.python import small_batches  # noqa: F401  (shared by the operators)
from ..storage import discard, stored  # noqa: F401  (shared by the operators)

MASK64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_GROUP_BYTES = 1 << 20

#: Bytes A-Z to a-z, all others unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur style), elementwise on uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = _BASE_INV
        _inverse = np.cumprod(steps, dtype=np.uint64)
    return _powers[:n], _inverse[:n]


def byte_class(separators: Iterable[int]) -> np.ndarray:
    """For each byte value, whether it belongs to a word."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but space and bytes 9 to 13.
NOT_BLANK = byte_class([32, *range(9, 14)])


class Words:
    """The words of a group of documents: arrays with one entry for each word."""

    def __init__(self, docs: list[bytes], table: np.ndarray = NOT_BLANK):
        self.n_docs = len(docs)
        lengths = np.fromiter((len(d) for d in docs), dtype=np.int64, count=len(docs))
        self.doc_end = np.cumsum(lengths + 1)
        self.buffer = np.frombuffer(b" ".join(docs) + b" ", dtype=np.uint8)
        inside = table[self.buffer]
        inside[self.doc_end - 1] = False
        step = np.diff(inside.view(np.int8), prepend=0)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        self.doc = np.searchsorted(self.doc_end, self.start, side="right")
        power, self._inv = _tables(len(self.buffer) + 1)
        self._sums = np.zeros(len(self.buffer) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[self.buffer] * power[: len(self.buffer)], out=self._sums[1:])

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A hash of the bytes of each span, wherever it stands."""
        return mix64((self._sums[end] - self._sums[start]) * self._inv[start] + (end - start).astype(np.uint64))

    def hashes(self) -> np.ndarray:
        return self.span_hash(self.start, self.end)


def groups(texts: list[bytes], limit: int = _GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts holding about ``limit`` bytes; a longer text is a range of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def utf8_list(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
