"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A document's set is its distinct shingles of ``width`` words (five unless told otherwise; two
in ``op1_minhash_neardup``). A signature holds SYMBOLS minimum hashes
cut to 16 bits each and is split into CHUNKS chunks. By the pigeonhole principle, two
signatures that differ in at most ``CHUNKS * (CHUNK_ERRORS + 1) - 1`` symbols agree, in some
chunk, in all but CHUNK_ERRORS symbols; so each signature is indexed under every chunk with
every choice of one symbol left out, and all pairs within that distance share an index key.
With 8 chunks of 5 that guarantees distance 15 of 40 and retrieves a pair at similarity 0.8
(expected distance 8) with probability over 0.99997.

Candidates are confirmed on full shingle sets, so a reported link is exact:

1.  Equal sets are one class (partial aggregation; copies are never paired).
2.  Index buckets with one member fall away; in each other bucket members are paired with
    the smallest one only, which is linear in the bucket's size, and links are contracted.
3.  Every bucket that still spans several components is searched in full, in blocks, for
    pairs across components. Only pairs that pass exact bounds leave that search, and none
    within a component, so a large group of copies gives no square of pairs.

Nodes of the link graph are classes of equal sets, numbered as they are written, so ids may be
null or repeat: a component's id is the smallest doc_id of its rows, and null if none has one.

Edge cases: null or blank texts have no shingles and are linked with nothing; fewer words than
``width`` are one shingle; repeated rows share a class; texts under one doc_id are told apart;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .native import bounded
from .textkit import LOWER, Words, discard, groups, mix64, small_batches, stored, table, utf8_list

CHUNKS, CHUNK_SYMBOLS, CHUNK_ERRORS = 8, 5, 1
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
GUARANTEED_DISTANCE = CHUNKS * (CHUNK_ERRORS + 1) - 1
#: Candidates may differ in so many symbols; at similarity 0.8 one in 100,000 pairs differs in more.
MAX_DISTANCE = 20
BITMAP_BYTES = 256
#: Words in a shingle.
WIDTH = 5
BLOCK = 1024

_LEFT, _RIGHT, _ALONE = np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SYMBOL_FACTORS = mix64(np.arange(1, SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash) of every distinct shingle, by document, then by hash."""
    words = Words([t.translate(LOWER) for t in texts])
    h = words.hashes()
    n = np.bincount(words.doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    if len(h) >= width:
        code = h[: len(h) - width + 1] * _LEFT
        for i in range(1, width):
            code = mix64(code) + h[i : len(h) - width + 1 + i] * _RIGHT
        whole = words.doc[: len(code)] == words.doc[width - 1 :]
        shingles, doc = mix64(code[whole]), words.doc[: len(code)][whole]
    else:
        shingles, doc = np.empty(0, np.uint64), np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < width))
    if short.size:
        code = np.zeros(len(short), np.uint64)
        for i in range(width - 1):
            has = n[short] > i
            code[has] = mix64(code[has] + h[first[short[has]] + i] * _ALONE)
        shingles, doc = np.concatenate([shingles, mix64(code + _ALONE)]), np.concatenate([doc, short])
    order = np.lexsort((shingles, doc))
    shingles, doc = shingles[order], doc[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingles[1:] != shingles[:-1])
    return doc[new], shingles[new]


def signatures(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(sets, SYMBOLS) uint16: the minimum of each hash over each set, cut to 16 bits."""
    out = np.empty((SYMBOLS, len(first)), dtype=np.uint16)
    for i, factor in enumerate(_SYMBOL_FACTORS):
        out[i] = mix64(np.minimum.reduceat(shingles * factor, first)) & np.uint64(0xFFFF)
    return np.ascontiguousarray(out.T)


def index_keys(signature: np.ndarray) -> np.ndarray:
    """(sets, CHUNKS * CHUNK_SYMBOLS) keys: each chunk with each of its symbols left out."""
    rows = signature.astype(np.uint64)
    out = np.empty((CHUNKS * CHUNK_SYMBOLS, len(rows)), dtype=np.uint64)
    for c in range(CHUNKS):
        for left_out in range(CHUNK_SYMBOLS):
            k = np.full(len(rows), c * CHUNK_SYMBOLS + left_out + 1, dtype=np.uint64)
            for j in range(CHUNK_SYMBOLS):
                if j != left_out:
                    k = mix64(k * _LEFT + rows[:, c * CHUNK_SYMBOLS + j])
            out[c * CHUNK_SYMBOLS + left_out] = k
    return out.T


def first_shared_key(sig_a: np.ndarray, sig_b: np.ndarray) -> np.ndarray:
    """The first of ``index_keys`` that the signatures of each pair share; each pair shares one."""
    same = (sig_a == sig_b).reshape(-1, CHUNKS, CHUNK_SYMBOLS)
    chunk = (same.sum(axis=2) >= CHUNK_SYMBOLS - CHUNK_ERRORS).argmax(axis=1)
    pair = np.arange(len(same))
    left_out = (~same[pair, chunk]).argmax(axis=1)
    k = (chunk * CHUNK_SYMBOLS + left_out + 1).astype(np.uint64)
    for j in range(CHUNK_SYMBOLS):
        k = np.where(left_out == j, k, mix64(k * _LEFT + sig_a[pair, chunk * CHUNK_SYMBOLS + j].astype(np.uint64)))
    return k.view(np.int64)


def bitmaps(doc: np.ndarray, shingles: np.ndarray, n_docs: int) -> np.ndarray:
    """(documents, BITMAP_BYTES) uint8: one bit set for each shingle."""
    bit = (mix64(shingles + _ALONE) % np.uint64(8 * BITMAP_BYTES)).astype(np.int64)
    wide = np.zeros((n_docs, 8 * BITMAP_BYTES), dtype=bool)
    wide[doc, bit] = True
    return np.packbits(wide, axis=1)


_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def can_link(n_a: np.ndarray, n_b: np.ndarray, sig_a: np.ndarray, sig_b: np.ndarray, map_a: np.ndarray, map_b: np.ndarray) -> np.ndarray:
    """Which pairs may reach similarity 0.8.

    Elements of a whose bit is not set in b are surely not in b, so bit counts bound the
    intersection from above; that bound and the sizes never reject a link.
    """
    ok = np.flatnonzero(5 * np.minimum(n_a, n_b) >= 4 * np.maximum(n_a, n_b))
    ok = ok[(sig_a[ok] != sig_b[ok]).sum(axis=1) <= MAX_DISTANCE]
    a, b = map_a[ok], map_b[ok]
    most = np.minimum(n_a[ok] - _POPCOUNT[a & ~b].sum(axis=1, dtype=np.int64), n_b[ok] - _POPCOUNT[b & ~a].sum(axis=1, dtype=np.int64))
    return ok[100 * most >= 80 * (n_a[ok] + n_b[ok] - most)]


def _fixed(column: pa.Array, width: int, dtype: str) -> np.ndarray:
    data = b"".join(column.cast(pa.binary()).to_pylist())
    return np.frombuffer(data, dtype=dtype).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _sketch(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, n, h1, h2, sig of each document; those without shingles have n = 0
    and no rest."""
    for batch in batches:
        texts = utf8_list(batch.column(2))
        for begin, end in groups(texts):
            doc, shingles = shingle_sets(texts[begin:end], width)
            count = np.bincount(doc, minlength=end - begin)
            full = np.flatnonzero(count)
            first = np.concatenate([[0], np.cumsum(count[full])[:-1]]).astype(np.int64) if full.size else np.empty(0, np.int64)
            h1, h2 = np.zeros(end - begin, np.uint64), np.zeros(end - begin, np.uint64)
            sig: list[bytes | None] = [None] * (end - begin)
            if full.size:
                h1[full] = np.add.reduceat(mix64(shingles ^ _LEFT), first)
                h2[full] = np.add.reduceat(mix64(shingles ^ _RIGHT), first)
                for i, row in zip(full, signatures(shingles, first), strict=True):
                    sig[i] = row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(begin, end - begin) for c in (0, 1)),
                    pa.array(count.astype(np.int64)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(sig, pa.binary()),
                ],
                names=["doc_id", "text_hash", "n", "h1", "h2", "sig"],
            )


def _emit_keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = index_keys(_fixed(batch.column(1), SYMBOLS, "<u2")).view(np.int64)
        reps = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys).reshape(-1)), pa.array(reps)], names=["key", "rep"])


def _full_sets(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8_list(batch.column(1))
        for begin, end in groups(texts):
            doc, shingles = shingle_sets(texts[begin:end], width)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=end - begin))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), lists, _binary(bitmaps(doc, shingles, end - begin))], names=["rep", "shingles", "bitmap"])


def _keep_possible(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns a, b, n_a, n_b, sig_a, sig_b, map_a, map_b: the pairs that pass ``can_link``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        sig = [_fixed(batch.column(i), SYMBOLS, "<u2") for i in (4, 5)]
        bit = [_fixed(batch.column(i), BITMAP_BYTES, "u1") for i in (6, 7)]
        ok = can_link(n_a, n_b, *sig, *bit)
        yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["a", "b"])


def _search_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, part): rep, component, side, n, sig, bitmap. Pairs across components
    that pass ``can_link``, each from the first bucket that it shares only. A group has about
    2 * BLOCK rows at most and may span batches."""

    def search(rows: pa.Table) -> pa.RecordBatch:
        key, part, rep, label, side, n = (rows.column(i).to_numpy() for i in range(6))
        sig = _fixed(rows.column(6).combine_chunks(), SYMBOLS, "<u2")
        bit = _fixed(rows.column(7).combine_chunks(), BITMAP_BYTES, "u1")
        found: list[np.ndarray] = []
        live = np.arange(len(rep) - 1)
        lag = 1
        while live.size:
            live = live[live + lag < len(rep)]
            live = live[(key[live] == key[live + lag]) & (part[live] == part[live + lag])]
            # In a group of two blocks, pairs inside a block belong to that block's own group.
            i = live[(label[live] != label[live + lag]) & ((side[live] < 0) | (side[live] != side[live + lag]))]
            for at in range(0, len(i), 1 << 16):
                x = i[at : at + (1 << 16)]
                y = x + lag
                ok = can_link(n[x], n[y], sig[x], sig[y], bit[x], bit[y])
                x, y = x[ok], y[ok]
                here = first_shared_key(sig[x], sig[y]) == key[x]
                if here.any():
                    found.append(np.sort(np.stack([rep[x[here]], rep[y[here]]], axis=1), axis=1))
            lag += 1
        pairs = np.concatenate(found) if found else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        if held.num_rows < 16384:
            continue
        key, part = held.column(0).to_numpy(), held.column(1).to_numpy()
        inside = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1]))
        if inside.size:
            cut = int(inside[-1]) + 1
            yield search(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield search(held)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
    return both.where("100L * common >= 80L * (size(set_a) + size(set_b) - common)").select("a", "b")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash, group for every row of ``docs``.

    ``text_hash`` is xxhash64 of the text (null: empty) and tells texts under one doc_id apart;
    ``group`` numbers the components and is null without shingles. ``kept`` is
    ``doc_id = component_id``, null-safe.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    sketch = stored(docs.mapInArrow(lambda x: _sketch(x, width), "doc_id long, text_hash long, n long, h1 long, h2 long, sig binary"), "sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    classes = sketch.where("n > 0").groupBy("h1", "h2").agg(first, F.first("n").alias("n"), F.first("sig").alias("sig"))
    # Numbers are fixed by writing them.
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    facts = classes.select("rep", "n", "sig")

    keys = classes.select("rep", "sig").mapInArrow(_emit_keys, "key long, rep long")
    shared = keys.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre < last")
    buckets = stored(keys.join(shared, "key").select("key", "rep", "centre", "members"), "buckets")

    involved = classes.join(buckets.select("rep").distinct(), "rep", "left_semi").select("rep", "first")
    d, c = docs.alias("d"), involved.alias("c")
    one = F.col("d.doc_id").eqNullSafe(F.col("c.first.doc_id")) & (F.col("d.text_hash") == F.col("c.first.text_hash"))
    # A row that repeats meets its class more than once.
    first_text = d.join(c, one).select("rep", "text").dropDuplicates(["rep"])
    sets = stored(first_text.mapInArrow(lambda x: _full_sets(x, width), "rep long, shingles array<long>, bitmap binary"), "sets")
    facts = stored(sets.join(facts, "rep").select("rep", "n", "sig", "bitmap"), "facts")

    def named(side: str) -> DataFrame:
        return facts.select(*(F.col(c).alias(n) for c, n in zip(facts.columns, (side, f"n_{side}", f"sig_{side}", f"map_{side}"), strict=True)))

    stars = buckets.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    stars = stars.join(named("a"), "a").join(named("b"), "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b", "map_a", "map_b")
    links = stored(confirm(stars.mapInArrow(_keep_possible, "a long, b long"), sets), "links")
    labels = connected_components(links)

    # What is left: pairs of one bucket in different components.
    labelled = buckets.join(labels, buckets.rep == labels.node, "left").select("key", "rep", "members", F.coalesce("component", "rep").alias("component"))
    spread = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    rows = labelled.join(spread, "key").join(facts, "rep")
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).cast("long").alias("part"), "rep", "component",
        F.when(F.col("blocks") == 1, -1).when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine")).cast("long").alias("side"),
        "n", "sig", "bitmap",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    crossing = rows.repartition(parts, "key", "part").sortWithinPartitions("key", "part").mapInArrow(_search_blocks, "a long, b long")
    more = stored(confirm(crossing, sets), "links")
    # A class without links is its own component; links across components join those.
    owner = classes.join(labels, classes.rep == labels.node, "left").select("h1", "h2", "first.doc_id", "rep", F.coalesce("component", "rep").alias("group"))
    owner = stored(owner, "owners")
    if not more.isEmpty():
        a, b = (owner.select(F.col("rep").alias(c), F.col("group").alias(f"group_{c}")) for c in "ab")
        joined = connected_components(more.join(a, "a").join(b, "b").select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
        owner = owner.join(joined, owner.group == joined.node, "left").withColumn("group", F.coalesce("component", "group")).drop("node", "component")
    owner = owner.drop("rep")
    lowest = owner.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    owner = owner.drop("doc_id").join(lowest, "group")
    out = sketch.join(owner, ["h1", "h2"], "left")
    has = F.col("n") > 0
    out = out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(has, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_hash", F.when(has, F.col("group")).alias("group"),
    )
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash", "group")


def deduplicate(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (a null one last),
    of those the one with the smallest text hash. Of rows with one id and text one stays, an
    arbitrary one where their other columns differ. Texts without words all stay, but for such
    repeats."""
    rows = stored(near_duplicates(docs, width).select("doc_id", "text_hash", "group"), "groups")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    rows = rows.groupBy("group", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    best = rows.where("group is not null").groupBy("group").agg(F.min_by(F.struct("doc_id", "text_hash", "copies"), key).alias("w")).select("w.*")
    winners = stored(best.unionByName(rows.where("group is null").select("doc_id", "text_hash", "copies")), "winners")

    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    inner = inner.withColumn("text_hash", F.xxhash64(F.coalesce(text, F.lit("")))).alias("d")

    def those(keys: DataFrame) -> DataFrame:
        return inner.join(keys.alias("w"), doc_id.cast("long").eqNullSafe(F.col("w.doc_id")) & (F.col("d.text_hash") == F.col("w.text_hash")), "left_semi")

    repeated = winners.where("copies > 1")
    n_repeated = repeated.count()
    out = those(winners.where("copies = 1"))
    if n_repeated:
        id_column = names[docs.columns.index("doc_id")]
        out = out.unionByName(those(bounded(repeated, n_repeated)).dropDuplicates([id_column, "text_hash"]))
    return out.select(*names).toDF(*docs.columns)


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 2).drop("text_hash", "group")


#: Every pair that shares a shingle is compared: right, and quadratic, so for small tables only.
ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]] ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
c AS (SELECT node, min(root) AS root FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""
