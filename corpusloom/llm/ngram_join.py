"""N-gram Jaccard join by signature trees.

A text's set is its distinct shingles of ``width`` words; two texts link when their sets' overlap
is ``percent`` of their union or more. The search loses no link:

1.  Equal sets are one class (partial aggregation; copies are never paired).
2.  Classes are dealt to trees. Sizes fall into bands. Two sets whose larger one is in a band
    differ in at most ``d`` shingles; the hash space is cut into ``d + 1 + spare`` segments, so in
    ``1 + spare`` of them they agree wholly. A set goes to a tree for every segment of its band,
    named by what it holds there, and if it is large enough also to those of the next band. A
    set with no more than ``spare`` empty segments leaves those out: two sets that agree in so
    many agree in one that isn't empty.
3.  In each tree every class is first held against the smallest one only, which is linear in the
    tree's size: pairs that sizes and bitmaps allow, on full sets; links are contracted to
    components.
4.  A tree that still spans several components is searched by its nodes. Its leaves' members
    are in order of component and size, and every node holds the OR of its members' token
    bitmaps, their range of sizes and of components. Node pairs are pruned where sizes cannot
    match, where both are one component, or where the bits that both maps share leave too
    small an overlap; what remains is opened down to members, and their pairs to full sets.
    The upper nodes are joined by Spark, so that a hot tree is spread over tasks by node pairs.

Full sets travel once for a block of pairs with one first member, not with each pair.

Edge cases: null or blank texts have no shingles and are linked with nothing; fewer words than
``width`` are one shingle; repeated rows share a class; ids may be null or repeat (a component's
id is the smallest doc_id of its rows, null if none has one); an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import connected_components
from .native import bounded
from .neardup import shingle_sets
from .textkit import discard, groups, mix64, small_batches, stored, table, utf8_list

WIDTH, PERCENT = 3, 90
#: Bits of a bitmap for each shingle of the largest set of a band, at least.
BITS_PER_SHINGLE = 4
#: Members of a leaf that leaves one task whole, and of the nodes below it.
LEAF, TWIG = 256, 16
#: Pairs with one first member that a task confirms against one copy of its set.
CONFIRM_BLOCK = 256

_A, _B, _C = np.uint64(0x9DDFEA08EB382D69), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


@dataclass(frozen=True)
class Bands:
    """Bands of set sizes for a threshold: the largest size of each, and its segments."""

    percent: int
    tops: np.ndarray
    segments: np.ndarray
    spare: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(percent: int) -> Bands:
        # Sizes below a band's neighbour link with nothing in it.
        growth = 1.08 * 100 / percent
        tops = [max(1, -(-(100 + percent) // (2 * (100 - percent))) - 1)]
        while tops[-1] < 1 << 40:
            tops.append(max(tops[-1] + 1, int((tops[-1] + 1) * growth)))
        top = np.array(tops, dtype=np.int64)
        bits = np.array([max(256, 1 << int(BITS_PER_SHINGLE * t - 1).bit_length()) for t in tops], dtype=np.int64)
        needed = 2 * top * (100 - percent) // (100 + percent) + 1
        spare = np.minimum(6, needed // 20)
        return Bands(percent, top, needed + spare, spare, bits)

    def of_size(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, n, side="left")

    def reaches(self, n: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Whether sets of size n can link with one of a higher band."""
        return 100 * n >= self.percent * (self.tops[band - 1] + 1)


def tree_names(doc: np.ndarray, shingles: np.ndarray, n: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(document, tree) of every tree that a document's set goes to; the tree's low byte is its band.

    Shingles come by document, then by hash; segments are ranges of hashes, so each one's are
    together. A band whose sets may not differ has no trees: its links are equal sets.
    """
    docs, names = [], []
    own = bands.of_size(n)
    value = mix64(shingles ^ _C)
    for step in range(len(bands.tops)):
        band = own + step
        into = np.flatnonzero((n > 0) & (bands.reaches(n, band) if step else True))
        if not into.size:
            break
        into = into[bands.segments[band[into]] > 1]
        many = np.zeros(len(n), dtype=np.int64)
        many[into] = bands.segments[band[into]]
        first = np.cumsum(many) - many
        sums, filled = np.zeros(int(many.sum()), dtype=np.uint64), np.zeros(int(many.sum()), dtype=bool)
        use = many[doc] > 0
        d = doc[use]
        cell = first[d] + (((shingles[use] >> np.uint64(32)) * many[d].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        if cell.size:
            starts = np.flatnonzero(np.diff(cell, prepend=-1))
            sums[cell[starts]] = np.add.reduceat(value[use], starts)
            filled[cell] = True
        of = np.repeat(np.arange(len(n)), many)
        segment = (np.arange(len(sums)) - first[of]).astype(np.uint64)
        name = mix64(sums * _A + mix64(segment * _B + band[of].astype(np.uint64)))
        empty = many - np.bincount(of[filled], minlength=len(n))
        goes = filled | (empty > bands.spare[band])[of]
        docs.append(of[goes])
        names.append(((name & ~np.uint64(0xFF)) | band[of].astype(np.uint64))[goes])
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(docs), np.concatenate(names)


def bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    """One bit set for each shingle, as words of 64; ``bits`` is a power of two."""
    wide = np.zeros(bits, dtype=bool)
    wide[(mix64(shingles + _B) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(wide, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of the same set with fewer bits."""
    while 64 * len(words) > bits:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


def can_link(n_a: np.ndarray, n_b: np.ndarray, map_a: np.ndarray, map_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs of sets may link: a bit of one map that the other lacks is a shingle that it
    lacks, so counts of such bits bound the overlap from above."""
    most = np.minimum(n_a - np.bitwise_count(map_a & ~map_b).sum(axis=-1, dtype=np.int64), n_b - np.bitwise_count(map_b & ~map_a).sum(axis=-1, dtype=np.int64))
    return 100 * most >= percent * (n_a + n_b - most)


@dataclass
class Nodes:
    """Nodes of one level: what pruning needs of each."""

    union: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray
    most: np.ndarray
    slack: np.ndarray

    @staticmethod
    def over(component: np.ndarray, n: np.ndarray, maps: np.ndarray, starts: np.ndarray) -> Nodes:
        slack = n - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        return Nodes(
            np.bitwise_or.reduceat(maps, starts, axis=0), np.minimum.reduceat(component, starts), np.maximum.reduceat(component, starts),
            np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts), np.maximum.reduceat(slack, starts),
        )

    def __getitem__(self, at: np.ndarray | slice) -> Nodes:
        return Nodes(*(x[at] for x in (self.union, self.low, self.high, self.least, self.most, self.slack)))


def may_hold_links(x: Nodes, y: Nodes, percent: int) -> np.ndarray:
    """Which node pairs may hold a link between components.

    Members share no more bits than the two unions do, and a set has at most ``slack`` shingles
    more than bits, so the unions' common bits and the slack bound every overlap below them.
    """
    one = (x.low == x.high) & (y.low == y.high) & (x.low == y.low)
    sizes = (100 * x.most >= percent * y.least) & (100 * y.most >= percent * x.least)
    overlap = np.bitwise_count(x.union & y.union).sum(axis=-1, dtype=np.int64) + np.minimum(x.slack, y.slack)
    return ~one & sizes & ((100 + percent) * overlap >= percent * (x.least + y.least))


def _sketch(batches: Iterable[pa.RecordBatch], width: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    """doc_id, text_hash, n, h1, h2 and trees of each document."""
    for batch in batches:
        texts = utf8_list(batch.column(2))
        for begin, end in groups(texts):
            doc, shingles = shingle_sets(texts[begin:end], width)
            n = np.bincount(doc, minlength=end - begin).astype(np.int64)
            full = np.flatnonzero(n)
            h1, h2 = np.zeros(end - begin, np.uint64), np.zeros(end - begin, np.uint64)
            if full.size:
                first = (np.cumsum(n) - n)[full]
                h1[full] = np.add.reduceat(mix64(shingles ^ _A), first)
                h2[full] = np.add.reduceat(mix64(shingles ^ _B), first)
            of, names = tree_names(doc, shingles, n, bands)
            order = np.argsort(of, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=end - begin))]).astype(np.int32)
            trees = pa.ListArray.from_arrays(pa.array(ends), pa.array(names[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(begin, end - begin) for c in (0, 1)), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), trees],
                names=["doc_id", "text_hash", "n", "h1", "h2", "trees"],
            )


def _sets(batches: Iterable[pa.RecordBatch], width: int, bands: Bands) -> Iterator[pa.RecordBatch]:
    """rep, n, shingles and bitmap (wide enough for the next band) of each text."""
    for batch in batches:
        texts = utf8_list(batch.column(1))
        for begin, end in groups(texts):
            doc, shingles = shingle_sets(texts[begin:end], width)
            n = np.bincount(doc, minlength=end - begin).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            bits = bands.bits[bands.of_size(n) + 1]
            maps = [bitmap(shingles[a:b], int(w)).tobytes() for a, b, w in zip(ends[:-1], ends[1:], bits, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, end - begin), pa.array(n), pa.ListArray.from_arrays(pa.array(ends), pa.array(shingles.view(np.int64))), pa.array(maps, pa.binary())],
                names=["rep", "n", "shingles", "bitmap"],
            )


def _confirmed(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows a, block, side, rep, shingles sorted by those: each block's first member, then those
    held against it. The pairs that link."""
    head: np.ndarray = np.empty(0, np.uint64)
    for batch in batches:
        a, side, rep = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
        lists = batch.column(4)
        ends = np.asarray(lists.offsets, dtype=np.int64)
        flat = np.asarray(lists.values).view(np.uint64)
        linked = np.zeros(len(a), dtype=bool)
        begin = 0
        for cut in [*np.flatnonzero(side == 0), len(a)]:
            if cut > begin:
                values = flat[ends[begin] : ends[cut]]
                at = np.searchsorted(head, values)
                hit = np.zeros(len(values), dtype=np.int64)
                inside = at < len(head)
                hit[inside] = head[at[inside]] == values[inside]
                n = np.diff(ends[begin : cut + 1])
                common = np.add.reduceat(hit, ends[begin:cut] - ends[begin])
                linked[begin:cut] = 100 * common >= percent * (len(head) + n - common)
            if cut < len(a):
                head = flat[ends[cut] : ends[cut + 1]].copy()
            begin = cut + 1
        yield pa.RecordBatch.from_arrays([pa.array(a[linked]), pa.array(rep[linked])], names=["a", "b"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b: stored, each once) that link, by full sets (rep, shingles: each by
    ascending unsigned hash, none empty). The set of ``a`` is sent once for CONFIRM_BLOCK pairs."""
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = pairs.groupBy("a").agg(F.ceil(F.count("*") / CONFIRM_BLOCK).alias("blocks"))
    dealt = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), "blocks").alias("block"), "b")
    heads = dealt.select("a", "block").distinct().join(sets, F.col("a") == F.col("rep")).select("a", "block", F.lit(0).alias("side"), "rep", "shingles")
    members = dealt.join(sets, F.col("b") == F.col("rep")).select("a", "block", F.lit(1).alias("side"), "rep", "shingles")
    rows = heads.unionByName(members).repartition(parts, "a", "block").sortWithinPartitions("a", "block", "side")
    return rows.mapInArrow(lambda x: _confirmed(x, percent), "a long, b long")


def _possible(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """a, b, n_a, n_b, map_a, map_b: the pairs whose sets may link."""
    for batch in batches:
        n_a, n_b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        maps = [[np.frombuffer(m, dtype=np.uint64) for m in batch.column(i).to_pylist()] for i in (4, 5)]
        width = np.array([min(len(x), len(y)) for x, y in zip(*maps, strict=True)], dtype=np.int64)
        keep = np.zeros(batch.num_rows, dtype=bool)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            a, b = (np.stack([folded(side[i], 64 * int(w)) for i in at]) for side in maps)
            keep[at] = can_link(n_a[at], n_b[at], a, b, percent)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])


def _leaves(batches: Iterable[pa.RecordBatch], bands: Bands) -> Iterator[pa.RecordBatch]:
    """Rows tree, component, n, rep, bitmap in order: each tree's rows in leaves of LEAF."""
    task = TaskContext.get()
    number = (task.partitionId() if task else 0) << 32

    def leaf(rows: pa.Table) -> pa.RecordBatch:
        nonlocal number
        tree = rows["tree"][0].as_py()
        bits = int(bands.bits[tree & 0xFF])
        component, n = rows["component"].to_numpy(), rows["n"].to_numpy()
        maps = np.stack([folded(np.frombuffer(m, dtype=np.uint64), bits) for m in rows["bitmap"].to_pylist()])
        top = Nodes.over(component, n, maps, np.zeros(1, dtype=np.int64))
        number += 1
        row = {
            "tree": tree, "node": number, "low": int(top.low[0]), "high": int(top.high[0]), "least": int(top.least[0]), "most": int(top.most[0]), "slack": int(top.slack[0]),
            "union": top.union[0].tobytes(), "components": component, "sizes": n, "reps": rows["rep"].to_numpy(), "maps": maps.tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=_LEAF_SCHEMA)

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        cuts = [0, *(np.flatnonzero(np.diff(held["tree"].to_numpy())) + 1)]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            for at in range(begin, end, LEAF):
                yield leaf(held.slice(at, min(LEAF, end - at)))
        held = held.slice(cuts[-1])
        while held.num_rows > LEAF:
            yield leaf(held.slice(0, LEAF))
            held = held.slice(LEAF)
    if held is not None and held.num_rows:
        yield leaf(held)


_LEAF = "tree long, node long, low long, high long, least long, most long, slack long, union binary, components array<long>, sizes array<long>, reps array<long>, maps binary"
_LONGS = pa.list_(pa.int64())
_LEAF_SCHEMA = pa.schema([
    *((c, pa.int64()) for c in ("tree", "node", "low", "high", "least", "most", "slack")), ("union", pa.binary()),
    ("components", _LONGS), ("sizes", _LONGS), ("reps", _LONGS), ("maps", pa.binary()),
])


def _prune(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """x, y and both sides' low, high, least, most, slack, union: the node pairs to open."""
    for batch in batches:
        x, y = batch.column(0), batch.column(1)
        sides = []
        for k in (2, 8):
            unions = [np.frombuffer(u, dtype=np.uint64) for u in batch.column(k + 5).to_pylist()]
            sides.append((unions, [batch.column(k + i).to_numpy(zero_copy_only=False) for i in range(5)]))
        widths = np.array([len(u) for u in sides[0][0]], dtype=np.int64)
        keep = np.zeros(len(widths), dtype=bool)
        for width in np.unique(widths):
            at = np.flatnonzero(widths == width)
            a, b = (Nodes(np.stack([unions[i] for i in at]), *(v[at] for v in rest)) for unions, rest in sides)
            keep[at] = may_hold_links(a, b, percent)
        at = pa.array(keep)
        yield pa.RecordBatch.from_arrays([x.filter(at), y.filter(at)], names=["x", "y"])


def open_pair(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Members (component, n, maps of two leaves) that may link across components, by a descent
    through the leaves' twigs."""
    starts = [np.arange(0, len(s[0]), TWIG) for s in (x, y)]
    twigs = [Nodes.over(*s, at) for s, at in zip((x, y), starts, strict=True)]
    i, j = (g.ravel() for g in np.meshgrid(np.arange(len(starts[0])), np.arange(len(starts[1])), indexing="ij"))
    if same:
        i, j = i[i <= j], j[i <= j]
    ok = may_hold_links(twigs[0][i], twigs[1][j], percent)
    a = (starts[0][i[ok], None, None] + np.arange(TWIG)[None, :, None] + np.zeros((1, 1, TWIG), dtype=np.int64)).ravel()
    b = (starts[1][j[ok], None, None] + np.zeros((1, TWIG, 1), dtype=np.int64) + np.arange(TWIG)[None, None, :]).ravel()
    inside = (a < len(x[0])) & (b < len(y[0]))
    a, b = a[inside], b[inside]
    live = x[0][a] != y[0][b]
    if same:
        live &= a < b
    a, b = a[live], b[live]
    live = (100 * x[1][a] >= percent * y[1][b]) & (100 * y[1][b] >= percent * x[1][a])
    a, b = a[live], b[live]
    step = max(1, (4 << 20) // max(1, x[2].shape[1] * 8))
    found = [at + np.flatnonzero(can_link(x[1][a[at : at + step]], y[1][b[at : at + step]], x[2][a[at : at + step]], y[2][b[at : at + step]], percent)) for at in range(0, len(a), step)]
    keep = np.concatenate(found) if found else np.empty(0, np.int64)
    return a[keep], b[keep]


def _opened(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """One leaf or two a row (components, sizes, reps, maps of each): the pairs of members to
    confirm."""
    for batch in batches:
        same = batch.num_columns == 4
        pairs = [np.empty((0, 2), dtype=np.int64)]
        for row in range(batch.num_rows):
            sides = []
            for k in (0, 0) if same else (0, 4):
                component, n, rep = (batch.column(k + i)[row].values.to_numpy() for i in range(3))
                maps = np.frombuffer(batch.column(k + 3)[row].as_py(), dtype=np.uint64).reshape(len(n), -1)
                sides.append(((component, n, maps), rep))
            a, b = open_pair(sides[0][0], sides[1][0], same, percent)
            pairs.append(np.sort(np.stack([sides[0][1][a], sides[1][1][b]], axis=1), axis=1))
        # Near copies meet in many trees.
        found = np.unique(np.concatenate(pairs), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])


def search_trees(rows: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a, b) of ``rows`` (tree, component, n, rep, bitmap: stored) in one tree and different
    components that may link."""
    percent = bands.percent
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "component", "n", "rep"]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*order, "bitmap")
    leaves = stored(ordered.mapInArrow(lambda x: _leaves(x, bands), _LEAF), "leaves")
    facts = ["low", "high", "least", "most", "slack", "union"]
    x, y = (leaves.select("tree", "node", *facts).alias(s) for s in "xy")
    fit = (100 * F.col("x.most") >= percent * F.col("y.least")) & (100 * F.col("y.most") >= percent * F.col("x.least"))
    apart = ~((F.col("x.low") == F.col("x.high")) & (F.col("y.low") == F.col("y.high")) & (F.col("x.low") == F.col("y.low")))
    pairs = x.join(y, (F.col("x.tree") == F.col("y.tree")) & (F.col("x.node") <= F.col("y.node")) & fit & apart)
    pairs = pairs.select(F.col("x.node").alias("x"), F.col("y.node").alias("y"), *(F.col(f"{s}.{f}").alias(f"{s}_{f}") for s in "xy" for f in facts))
    pairs = stored(pairs.mapInArrow(lambda b: _prune(b, percent), "x long, y long"), "node-pairs")
    n_pairs = pairs.count()
    members = ["components", "sizes", "reps", "maps"]
    alone = leaves.join(bounded(pairs.where("x = y").select(F.col("x").alias("node")), n_pairs), "node", "left_semi").select(*members)
    x, y = (leaves.select(F.col("node").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in members)) for s in "xy")
    opened = bounded(pairs.where("x <> y"), n_pairs).join(x, "x").join(y, "y").select(*(f"{s}_{c}" for s in "xy" for c in members))
    inside, across = (f.mapInArrow(lambda b: _opened(b, percent), "a long, b long") for f in (alone, opened))
    return inside.unionByName(across).distinct()


def jaccard_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and ``group`` (the component's number; null without
    shingles) for every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    bands = Bands.of(percent)
    docs = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), "text")
    sketch = stored(docs.mapInArrow(lambda x: _sketch(x, width, bands), "doc_id long, text_hash long, n long, h1 long, h2 long, trees array<long>"), "sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    classes = sketch.where("n > 0").groupBy("h1", "h2").agg(first, F.first("trees").alias("trees"))
    # Numbers are fixed by writing them.
    wide = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "trees-by-class")
    narrow, classes = stored(sketch.drop("trees"), "sketch"), stored(wide.drop("trees"), "classes")
    discard(sketch)
    sketch = narrow

    met = Window.partitionBy("tree")
    trees = wide.select(F.explode("trees").alias("tree"), "rep")
    trees = trees.select("tree", "rep", F.min("rep").over(met).alias("centre"), F.count("*").over(met).alias("members")).where("members > 1")
    trees = stored(trees, "trees")
    discard(wide)

    involved = classes.join(trees.select("rep").distinct(), "rep", "left_semi").select("rep", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_hash") == F.col("first_hash"))
    rows = sketch.select("doc_id", "text_hash").groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies"))
    involved = stored(involved.join(rows, same).select("rep", "first_id", "first_hash", "copies"), "involved")
    n_involved = involved.count()

    def texts(wanted: DataFrame) -> DataFrame:
        return docs.join(bounded(wanted, n_involved), same).select("rep", "text")

    # Only a row that repeats meets its class more than once.
    repeated = involved.where("copies > 1")
    found = texts(involved.where("copies = 1"))
    if not repeated.isEmpty():
        found = found.unionByName(texts(repeated).dropDuplicates(["rep"]))
    sets = stored(found.mapInArrow(lambda x: _sets(x, width, bands), "rep long, n long, shingles array<long>, bitmap binary"), "sets")

    stars = trees.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    for side in "ab":
        stars = stars.join(sets.select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"map_{side}")), side)
    stars = stars.where((100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))).select("a", "b", "n_a", "n_b", "map_a", "map_b")
    stars = stored(stars.mapInArrow(lambda x: _possible(x, percent), "a long, b long"), "stars")
    links = stored(confirm(stars, sets.select("rep", "shingles"), percent), "links")
    labels = connected_components(links)

    # What is left: pairs of one tree, neither its smallest member, in different components. Near
    # copies that miss the threshold meet in many trees: those with the same members are one.
    labelled = trees.where("members > 2").join(labels, F.col("rep") == F.col("node"), "left").select("tree", "rep", F.coalesce("component", "rep").alias("component"))
    members = [F.bit_xor(F.xxhash64("rep", F.lit(salt))).alias(f"m{salt}") for salt in (1, 2)]
    spread = labelled.groupBy("tree").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("m0"), *members).where("low < high")
    spread = spread.groupBy("m0", "m1", "m2", F.pmod("tree", F.lit(256)).alias("band")).agg(F.min("tree").alias("tree")).select("tree")
    rows = labelled.join(spread, "tree").join(sets.select("rep", "n", "bitmap"), "rep").select("tree", "component", "n", "rep", "bitmap")
    more = search_trees(stored(rows, "spread"), bands)
    more = stored(confirm(stored(more, "candidates"), sets.select("rep", "shingles"), percent), "links")

    owner = classes.join(labels, F.col("rep") == F.col("node"), "left").select("h1", "h2", "first.doc_id", "rep", F.coalesce("component", "rep").alias("group"))
    owner = stored(owner, "owners")
    if not more.isEmpty():
        a, b = (owner.select(F.col("rep").alias(c), F.col("group").alias(f"group_{c}")) for c in "ab")
        joined = connected_components(more.join(a, "a").join(b, "b").select(F.col("group_a").alias("a"), F.col("group_b").alias("b")))
        owner = owner.join(joined, owner.group == joined.node, "left").withColumn("group", F.coalesce("component", "group")).drop("node", "component")
    lowest = owner.groupBy("group").agg(F.min("doc_id").alias("component_id"))
    owner = owner.select("h1", "h2", "group").join(lowest, "group")
    out = sketch.select("doc_id", "n", "h1", "h2").join(owner, ["h1", "h2"], "left")
    has = F.col("n") > 0
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(has, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.when(has, F.col("group")).alias("group"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("group")


#: Every pair that shares a shingle is compared: right, and quadratic, so for small tables only.
ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node WHERE r.root < e.b),
c AS (SELECT node, min(root) AS root FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.root AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
"""
