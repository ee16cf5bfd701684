"""Reproducible shuffle and sharding by a Feistel permutation over global row numbers.

Rows get global numbers 0..N-1 in a fixed order, a keyed Feistel network permutes the
smallest even-bit domain that holds N, and cycle walking brings values that fall outside
0..N-1 back inside. The place p of a row is then ``shard = p mod S``, ``slot = p div S``:
shard sizes differ by one row at most, and anyone who knows N, S, the key and a row number
can compute a row's place (or invert it) without reading any data.

Only (doc_id, size, crc) triples are shuffled, never texts. Row numbers come from hash
buckets of doc_id: the bucket counts (a bounded number, from a scan of one column) give
each bucket's offset, and ranks inside a bucket give the rest.

Edge cases: a null text has size 8 and the checksum of no bytes; a null doc_id is an
ordinary value; repeated rows get a place each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .textkit import table

SHARDS = 24
ROUNDS = 4


def _round_keys(key: int) -> list[int]:
    out = []
    for i in range(ROUNDS):
        z = (key + (i + 1) * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & ((1 << 64) - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & ((1 << 64) - 1)
        out.append(z ^ (z >> 31))
    return out


def half_bits(n: int) -> int:
    """Bits of each half of the smallest balanced domain that holds n values."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, bits: int, keys: list[int]) -> np.ndarray:
    mask = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & mask
    for k in keys:
        f = (right + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
        f ^= f >> np.uint64(32)
        f *= np.uint64(0xD6E8FEB86659FD93)
        left, right = right, left ^ ((f >> np.uint64(32)) & mask)
    return (left << np.uint64(bits)) | right


def permute(rows: np.ndarray, n: int, key: int) -> np.ndarray:
    """The place of each row number below n; a bijection on 0..n-1."""
    bits, keys = half_bits(n), _round_keys(key)
    x = _network(rows.astype(np.uint64), bits, keys)
    while (outside := np.flatnonzero(x >= np.uint64(n))).size:
        x[outside] = _network(x[outside], bits, keys)
    return x.astype(np.int64)


def unpermute(places: np.ndarray, n: int, key: int) -> np.ndarray:
    """The row number at each place: the inverse of ``permute``."""
    bits, keys = half_bits(n), _round_keys(key)
    mask = np.uint64((1 << bits) - 1)

    def back(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(bits), x & mask
        for k in reversed(keys):
            f = (left + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
            f ^= f >> np.uint64(32)
            f *= np.uint64(0xD6E8FEB86659FD93)
            left, right = right ^ ((f >> np.uint64(32)) & mask), left
        return (left << np.uint64(bits)) | right

    x = back(places.astype(np.uint64))
    while (outside := np.flatnonzero(x >= np.uint64(n))).size:
        x[outside] = back(x[outside])
    return x.astype(np.int64)


def row_numbers(rows: DataFrame, by: list[str], buckets: int = 4096) -> tuple[DataFrame, int]:
    """Add ``row_number`` (0..N-1): by hash bucket of the first column, then by all of ``by``.

    ``buckets`` bounds what reaches the driver (one count each) and sets how evenly the
    ranking is spread: rows / buckets are ranked in one sort.
    """
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(F.col(by[0])), F.lit(buckets)).cast("int")
    counts = dict(rows.groupBy(bucket.alias("b")).count().collect())
    offsets, total = [], 0
    for b in range(buckets):
        if b in counts:
            offsets.append((b, total))
            total += counts[b]
    start = spark.createDataFrame(offsets or [(0, 0)], "bucket int, offset long")
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*by))
    out = rows.withColumn("bucket", bucket).withColumn("rank", rank).join(F.broadcast(start), "bucket")
    return out.withColumn("row_number", F.col("offset") + F.col("rank") - 1).drop("bucket", "rank", "offset"), total


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: int = 20_240_607) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered, total = row_numbers(base, ["doc_id", "size", "text_crc32"])

    @F.pandas_udf("long")
    def place(rows: pd.Series) -> pd.Series:
        return pd.Series(permute(rows.to_numpy(), total, key))

    placed = numbered.withColumn("place", place("row_number"))
    return placed.select(
        "doc_id", "size", "text_crc32", "row_number",
        F.pmod(F.col("place"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"),
    )


def op9_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
