"""Edit-aware token counts.

A document's pre-tokens stand in blocks under a segment tree whose nodes hold the sums of
characters and tokens below them. An edit is located by descending the tree; only the
pre-tokens that it touches, and those before it that could have looked ahead into it, are
re-encoded, up to the first border that old and new text share (from there on the pattern
sees the same text, and it never looks back). Then the sums on the changed paths are updated.

The vocabulary is a file of byte-level BPE ranks, at a path that every executor sees.

Edge cases: null and empty texts have no tokens; an edit beyond the end is clipped to it;
repeated rows give equal results; very long texts are handled in blocks; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textkit import small_batches, table

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: How far past its own end the pattern can look.
LOOK_AHEAD = 3
BLOCK = 128
_MEMORY = 300_000


class Counter:
    """Token counts of pre-tokens, remembered in a bounded table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self._known: dict[str, int] = {}

    def of(self, piece: str) -> int:
        n = self._known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                if len(self._known) >= _MEMORY:
                    self._known.clear()
                self._known[piece] = n
        return n

    def pieces(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def count(self, text: str) -> int:
        get, of = self._known.get, self.of
        return sum([get(p) or of(p) for p in self.pattern.findall(text)])


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    with open(path, "rb") as f:
        return Counter({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)})


class EditableDocument:
    """A text whose token count follows its edits."""

    def __init__(self, text: str, tokens: Counter):
        self.text, self.tokens = text, tokens
        self.reencoded = 0
        self._build(tokens.pieces(text))

    def _build(self, pieces: list[str]) -> None:
        get, of = self.tokens._known.get, self.tokens.of
        self._blocks = [
            ([len(p) for p in part], [get(p) or of(p) for p in part])
            for part in (pieces[i : i + BLOCK] for i in range(0, len(pieces), BLOCK))
        ] or [([], [])]
        self._leaves = 1 << (len(self._blocks) - 1).bit_length()
        self._chars, self._tokens = [0] * (2 * self._leaves), [0] * (2 * self._leaves)
        for i, (lengths, counts) in enumerate(self._blocks):
            self._chars[self._leaves + i], self._tokens[self._leaves + i] = sum(lengths), sum(counts)
        for node in range(self._leaves - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
        self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self._tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The block that holds character ``at`` (or the last) and the characters before it."""
        node, before = 1, 0
        while node < self._leaves:
            node *= 2
            if at - before >= self._chars[node] and self._chars[node + 1]:
                before += self._chars[node]
                node += 1
        return node - self._leaves, before

    def edit(self, start: int, end: int, new: str) -> int:
        """Replace characters start..end; returns the new token count."""
        start = max(0, min(start, len(self.text)))
        end = max(start, min(end, len(self.text)))
        shift = len(new) - (end - start)
        text = self.text[:start] + new + self.text[end:]

        # The first pre-token that may change.
        first, before = self._find(max(0, start - LOOK_AHEAD))
        lengths = self._blocks[first][0]
        at, i = before, 0
        while i < len(lengths) and at + lengths[i] <= start - LOOK_AHEAD:
            at += lengths[i]
            i += 1

        # Old borders from there on, block by block, and new pre-tokens until both agree.
        block, j, old = first, i, at
        fresh: list[str] = []
        position = at
        for match in self.tokens.pattern.finditer(text, at):
            while old < position - shift and block < len(self._blocks):
                if j < len(self._blocks[block][0]):
                    old += self._blocks[block][0][j]
                    j += 1
                else:
                    block, j = block + 1, 0
            if position >= start + len(new) and old == position - shift and old >= end:
                break
            fresh.append(match.group())
            position = match.end()
        else:
            block, j = len(self._blocks), 0

        self.text = text
        self.reencoded += len(fresh)
        counts = [self.tokens.of(p) for p in fresh]
        tail = ([], []) if block >= len(self._blocks) else tuple(x[j:] for x in self._blocks[block])
        head = tuple(x[:i] for x in self._blocks[first])
        middle = ([len(p) for p in fresh], counts)
        self._blocks[first] = tuple(h + m + t for h, m, t in zip(head, middle, tail, strict=True))
        last = min(block, len(self._blocks) - 1)
        for b in range(first + 1, last + 1):
            self._blocks[b] = ([], [])
        if len(self._blocks[first][0]) > 8 * BLOCK:
            self._spread()
        else:
            nodes = set()
            for b in range(first, last + 1):
                node = self._leaves + b
                self._chars[node], self._tokens[node] = sum(self._blocks[b][0]), sum(self._blocks[b][1])
                nodes.add(node // 2)
            while nodes and nodes != {0}:
                for node in nodes:
                    self._sum(node)
                nodes = {n // 2 for n in nodes}
        return self.n_tokens

    def _spread(self) -> None:
        """Deal the pre-tokens out to blocks again, without encoding any."""
        lengths = [n for block in self._blocks for n in block[0]]
        counts = [n for block in self._blocks for n in block[1]]
        self._blocks = [(lengths[i : i + BLOCK], counts[i : i + BLOCK]) for i in range(0, len(lengths), BLOCK)] or [([], [])]
        self._leaves = 1 << (len(self._blocks) - 1).bit_length()
        self._chars, self._tokens = [0] * (2 * self._leaves), [0] * (2 * self._leaves)
        for i, (n, c) in enumerate(self._blocks):
            self._chars[self._leaves + i], self._tokens[self._leaves + i] = sum(n), sum(c)
        for node in range(self._leaves - 1, 0, -1):
            self._sum(node)

    def tokens_before(self, at: int) -> int:
        """Tokens of the pre-tokens that end at or before character ``at``."""
        block, before = self._find(at)
        node, total = block + self._leaves, 0
        while node > 1:
            if node & 1:
                total += self._tokens[node - 1]
            node //= 2
        ends, run = [], before
        for n in self._blocks[block][0]:
            run += n
            ends.append(run)
        return total + sum(self._blocks[block][1][: bisect.bisect_right(ends, at)])


def revision(text: str) -> list[tuple[int, int, str]]:
    """A fixed small revision of a text: a deletion, an insertion and a replacement at places
    given by its checksum. Positions are those at the time of each edit."""
    h, n = zlib.crc32(text.encode("utf-8", "surrogatepass")), len(text)
    a, b, c = h % (n + 1), (h >> 7) % (n + 1), (h >> 13) % (n + 1)
    return [(a, a + 12, ""), (b, b, " revised text"), (c, c + 5, "Don't 2024")]


def count_tokens(docs: DataFrame, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """doc_id, n_tokens and, after ``revision``, edited_tokens, edited_crc32 and reencoded (the
    number of pre-tokens that the edits made the operator encode)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(ranks)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                doc = EditableDocument(text or "", tokens)
                before = doc.n_tokens
                for edit in revision(doc.text):
                    doc.edit(*edit)
                rows.append((before, doc.n_tokens, zlib.crc32(doc.text.encode("utf-8", "surrogatepass")), doc.reencoded))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), pa.int64()) for c in columns)], names=["doc_id", "n_tokens", "edited_tokens", "edited_crc32", "reencoded"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, edited_tokens long, edited_crc32 long, reencoded long")


def op8_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
