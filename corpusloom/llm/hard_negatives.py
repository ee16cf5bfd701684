"""Hard-negative mining by a full sort of every anchor's scores.

Vectors become integers (``floor(256 * x)``), so scores are exact inner products. A row that an
anchor meets ranks by score, high to low, then by smaller id. An anchor's positives are its first
``positives`` other rows of the same label; for each of them the first ``negatives`` rows of
another label whose score lies between ``low`` and ``high`` percent of the positive's are kept.

Rows and anchors are both dealt into blocks of bounded size, and every block of rows meets the
anchors in blocks too, so that a task holds one block of rows and one of anchors whatever the
size of the tables or of a label:

1.  In each block an anchor's scores against all of its rows are sorted (lexsort by score and
    id); the first ``positives`` rows of its label leave the task, and Spark merges them.
2.  The anchors go round once more with their positives. In each block the sorted scores of the
    other labels are searched by bisection for each positive's upper limit, and the next
    ``negatives`` entries above its lower limit leave the task; Spark merges those.

A first entry over all rows is among the first entries of its block, so the merges are exact.

Edge cases: rows with a null id, label or vector, or with a null or non-finite component, take no
part; a shorter vector counts as ended by zeros; rows that repeat are rows of their own, and only
the anchor's own row is no candidate; equal scores go by id, and equal ids stay apart but in no
stated order; a score that isn't a long wraps round; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .textkit import stored, table

POSITIVES, NEGATIVES = 5, 3
#: A negative's score is from LOW to HIGH percent of its positive's.
LOW, HIGH = 50, 95
#: Rows of a block, and anchors that meet it at a time.
ROW_BLOCK, ANCHOR_BLOCK = 16384, 128
_EXACT = 1 << 53


def integer_vectors(rows: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, v (array of long) of the rows that take part; ``label`` may change labels."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(usable)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), v.alias("v"))


def _matrix(vectors: pa.ListArray, width: int = 0) -> np.ndarray:
    """The vectors as rows of one matrix, shorter ones ended by zeros."""
    ends = np.asarray(vectors.offsets, dtype=np.int64)
    flat = np.asarray(vectors.values, dtype=np.int64)
    lengths = np.diff(ends)
    out = np.zeros((len(lengths), max(width, int(lengths.max(initial=0)))), dtype=np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], lengths)] = flat[ends[0] : ends[-1]]
    return out


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, by floating-point products where those are exact."""
    width = max(anchors.shape[1], rows.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (anchors, rows))
    # Bounded in floats, as the largest long has no positive counterpart.
    if width * float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _percent(x: np.ndarray, percent: int) -> np.ndarray:
    """``x * percent / 100`` rounded down, where the product itself may be no long."""
    return x // 100 * percent + x % 100 * percent // 100


class _Block:
    """One block of rows, by ascending id so that a sort by score keeps ids in order."""

    def __init__(self, batch: pa.Table):
        ids = batch["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.row, self.label = ids[order], batch["row"].to_numpy()[order], batch["label"].to_numpy()[order]
        self.v = _matrix(batch["v"].combine_chunks())[order]

    def positives(self, batch: pa.Table, many: int) -> dict[str, np.ndarray]:
        out: list[tuple[np.ndarray, ...]] = []
        own, label = batch["row"].to_numpy(), batch["label"].to_numpy()
        found = scores(_matrix(batch["v"].combine_chunks()), self.v)
        for i in range(len(own)):
            same = np.flatnonzero((self.label == label[i]) & (self.row != own[i]))
            s = found[i, same]
            first = same[np.lexsort((self.ids[same], -s))[:many]]
            out.append((np.full(len(first), own[i]), self.ids[first], self.row[first], found[i, first]))
        return dict(zip(("anchor", "vec_id", "row", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True))

    def negatives(self, batch: pa.Table, many: int, low: int, high: int) -> dict[str, np.ndarray]:
        out: list[tuple[np.ndarray, ...]] = []
        own, label = batch["row"].to_numpy(), batch["label"].to_numpy()
        wanted = batch["scores"].combine_chunks()
        found = scores(_matrix(batch["v"].combine_chunks()), self.v)
        for i in range(len(own)):
            other = np.flatnonzero(self.label != label[i])
            s = found[i, other]
            order = np.lexsort((self.ids[other], -s))
            falling = -s[order]
            p = wanted[i].values.to_numpy()
            # The first entry at or below the upper limit, and what follows down to the lower one.
            at = np.searchsorted(falling, -_percent(p, high), side="left")
            end = np.searchsorted(falling, _percent(-p, low), side="right")
            take = np.clip(end - at, 0, many)
            positive = np.repeat(np.arange(len(p)), take)
            pick = other[order[np.repeat(at, take) + np.arange(take.sum()) - np.repeat(np.cumsum(take) - take, take)]]
            out.append((np.full(len(pick), own[i]), positive, self.ids[pick], self.row[pick], found[i, pick]))
        return dict(zip(("anchor", "positive", "vec_id", "row", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True))


def _meet(work, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block, a block's own rows before its anchors; ``work`` takes a block
    and some anchors."""
    kept: list[pa.Table] = []
    at, block = None, None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        number, side = rows["block"].to_numpy(), rows["side"].to_numpy()
        cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(side) != 0)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(number)], strict=True):
            if begin == end:
                continue
            if number[begin] != at:
                at, block, kept = number[begin], None, []
            part = rows.slice(begin, end - begin)
            if side[begin] == 0:
                kept.append(part)
                continue
            if block is None and kept:
                block, kept = _Block(pa.concat_tables(kept)), []
            for first in range(0, part.num_rows if block is not None else 0, ANCHOR_BLOCK):
                found = work(block, part.slice(first, ANCHOR_BLOCK))
                yield pa.RecordBatch.from_pydict({k: pa.array(v.astype(np.int64)) for k, v in found.items()})


def _against_all(rows: DataFrame, anchors: DataFrame, blocks: int, work, schema: str) -> DataFrame:
    """``work`` over every block of rows with every anchor."""
    one = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("side", F.lit(0))
    two = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("side", F.lit(1))
    both = one.unionByName(two, allowMissingColumns=True).repartition(blocks, "block").sortWithinPartitions("block", "side")
    return both.mapInArrow(lambda x: _meet(work, x), schema)


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, row_block: int = ROW_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score over ``rows`` (see
    ``integer_vectors``); ``anchor`` says by vec_id which rows are anchors."""
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    blocks = max(-(-rows.count() // row_block), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    anchors = rows.where(anchor)

    def first(found: DataFrame, key: list[str], many: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("score").desc(), "vec_id", "row"))
        return found.withColumn("rank", rank).where(F.col("rank") <= many)

    found = _against_all(rows, anchors, blocks, lambda b, a: b.positives(a, positives), "anchor long, vec_id long, row long, score long")
    # No more than ``positives`` for an anchor.
    listed = first(found, ["anchor"], positives).groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    listed = stored(anchors.join(listed, F.col("row") == F.col("anchor")).select("vec_id", "label", "v", "row", F.col("p.vec_id").alias("ids"), F.col("p.score").alias("scores")), "positives")

    found = _against_all(rows, listed.drop("ids"), blocks, lambda b, a: b.negatives(a, negatives, low, high), "anchor long, positive long, vec_id long, row long, score long")
    out = first(found, ["anchor", "positive"], negatives).alias("n").join(listed.alias("a"), F.col("n.anchor") == F.col("a.row"))
    return out.select(
        F.col("a.vec_id").alias("anchor_id"), F.get("a.ids", F.col("positive").cast("int")).alias("positive_id"), F.col("rank").cast("long").alias("rank"),
        F.col("n.vec_id").alias("negative_id"), F.get("a.scores", F.col("positive").cast("int")).alias("positive_score"), F.col("n.score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = integer_vectors(table(spark, sf_dir, "embeddings"), label)
    return mine(rows, F.col("vec_id") % 50 == 0).withColumn("rank", F.col("rank").cast("int"))


ORACLE_SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM r a, r b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, (row_number() OVER w)::INT AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER w <= 3
"""
