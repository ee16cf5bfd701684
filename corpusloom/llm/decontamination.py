"""Benchmark decontamination by a distributed positional inverted index.

The index holds a posting (term, document, position) for every occurrence of a benchmark
term in the training texts, and one more row for each document with its number of words.
Each benchmark window is looked up from its rarest terms: their posting lists, shifted by
the term's offset in the window, are intersected by (document, cell of starts, window), with a
tolerance of SLOP. What meets in all of them is compared with the document's words, so a
reported phrase is exact, and so is a proximity match: an occurrence of the window's rarest
term such that its other anchor terms stand within SLOP of their places relative to it.
``proximity`` gives the same matches from the index alone.

Only DataFrame functions are used. Posting lists are never gathered: they stay rows, and a
frequent term costs as many rows as it has occurrences.

Edge cases: null and empty texts have no words; an item without words has no window; an item
shorter than a window is one window; repeated documents and items count as they stand; a null
doc_id is a document; empty tables give no rows or no hits; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .native import ascii_lower, bounded, words
from .textkit import stored, table

WINDOW = 10
RAREST = 3
#: Positions by which a term may be off its place in a proximity match.
SLOP = 2
#: Places in a cell that anchors meet in.
CELL = 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return words(ascii_lower(text), SEPARATORS)


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(window, phrase, n) with window a number, and (window, item_id) for each item it occurs in."""
    w = benchmark.select("item_id", _words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1))))
    rows = w.select("item_id", "w", starts.alias("s")).select("item_id", F.array_join(F.slice("w", F.col("s"), width), " ").alias("phrase")).distinct()
    rows = rows.withColumn("window", F.xxhash64("phrase"))
    windows = rows.select("window", "phrase").distinct().withColumn("n", F.size(F.split("phrase", " ")))
    return windows, rows.select("window", "item_id").distinct()


def build_index(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """Postings (term_id, doc_id, text_hash, position) of the given (term, term_id); term_id -1
    has a document's number of words as its position."""
    # The row with the number of words has a term of its own, so that they don't share a key.
    last = F.concat(F.lit(" "), F.xxhash64("text").cast("string"))
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.array_append(_words(F.col("text")), last)).alias("position", "term"))
    found = tokens.join(bounded(terms, n_terms), "term", "left").where("term_id is not null or term like ' %'")
    return found.select(F.coalesce("term_id", F.lit(-1)).alias("term_id"), "doc_id", "text_hash", "position")


def anchors(windows: DataFrame, terms: DataFrame, frequency: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(term_id, window, offset, r, needed): the rarest terms of each window by their frequency;
    ``r`` counts them from 1, the rarest."""
    each = windows.select("window", F.posexplode(F.split("phrase", " ")).alias("offset", "term")).join(terms, "term")
    known = each.join(frequency, "term_id", "left").withColumn("f", F.coalesce("f", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("window").orderBy("f", "offset"))
    top = known.withColumn("r", rank).where(F.col("r") <= rarest)
    return top.withColumn("needed", F.count("*").over(Window.partitionBy("window"))).select("term_id", "window", "offset", "r", "needed")


def _shifted(index: DataFrame, anchor_rows: DataFrame, n_anchors: int) -> DataFrame:
    """Postings of anchor terms by the place where their window would start."""
    start = (F.col("position") - F.col("offset")).alias("start")
    return index.join(bounded(anchor_rows, n_anchors), "term_id").select("doc_id", "text_hash", start, "window", "r", "needed")


def candidates(index: DataFrame, anchor_rows: DataFrame, n_anchors: int, slop: int = 0, width: int = 1) -> DataFrame:
    """(doc_id, text_hash, start, window) where all anchor terms of a window meet, give or take
    ``slop`` places, in the cell of ``width`` places from ``start`` on."""
    shifted = _shifted(index, anchor_rows, n_anchors).where(F.col("start") >= -slop)
    cells = F.sequence(F.floor((F.col("start") - slop) / width), F.floor((F.col("start") + slop) / width))
    placed = shifted.withColumn("cell", F.explode(cells) if slop else F.floor(F.col("start") / width))
    met = placed.groupBy("doc_id", "text_hash", "cell", "window").agg(F.bit_or(F.expr("shiftleft(1, r - 1)")).alias("mask"), F.first("needed").alias("needed"))
    met = met.where(F.bit_count("mask") == F.col("needed"))
    return met.select("doc_id", "text_hash", (F.col("cell") * width).cast("int").alias("start"), "window")


def proximity(index: DataFrame, anchor_rows: DataFrame, n_anchors: int, slop: int) -> DataFrame:
    """(doc_id, text_hash, window): each anchor term stands within ``slop`` positions of its
    place relative to an occurrence of the rarest one."""
    shifted = _shifted(index, anchor_rows, n_anchors).withColumn("cell", F.floor(F.col("start") / (slop + 1)))
    rarest, rest = shifted.where("r = 1").alias("p"), shifted.where("r > 1")
    rest = rest.withColumn("cell", F.explode(F.array(*(F.col("cell") + k for k in (-1, 0, 1))))).alias("q")
    same = F.col("p.doc_id").eqNullSafe(F.col("q.doc_id"))
    for c in ("text_hash", "window", "cell"):
        same &= F.col(f"p.{c}") == F.col(f"q.{c}")
    pairs = rarest.join(rest, same & (F.abs(F.col("p.start") - F.col("q.start")) <= slop))
    near = pairs.groupBy("p.doc_id", "p.text_hash", "p.window", "p.start").agg(F.bit_count(F.bit_or(F.expr("shiftleft(1, q.r - 1)"))).alias("others"), F.first("p.needed").alias("needed"))
    near = near.where("others = needed - 1").select("doc_id", "text_hash", "window")
    alone = shifted.where("needed = 1").select("doc_id", "text_hash", "window")
    return near.unionByName(alone).distinct()


def find(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, slop: int = SLOP) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_hash, n_words) of every document, its exact hits (doc_id, text_hash, start,
    window, n), its proximity matches (doc_id, text_hash, window), and the (window, item_id) pairs."""
    docs = docs.select("doc_id", "text")
    windows, items = benchmark_windows(benchmark.select("item_id", "text"), width)
    windows = stored(windows, "windows")
    terms = windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    terms = stored(terms.withColumn("term_id", F.xxhash64("term")), "terms")
    index = stored(build_index(docs, terms, terms.count()), "postings")
    frequency = index.groupBy("term_id").agg(F.count("*").alias("f"))
    anchor_rows = stored(anchors(windows, terms, frequency), "anchors")
    found = stored(candidates(index, anchor_rows, anchor_rows.count(), slop, CELL), "candidates")

    keys = found.select("doc_id", "text_hash").distinct()
    n_keys = keys.count()
    near = docs.withColumn("text_hash", F.xxhash64("text")).alias("d")
    chosen = bounded(keys, n_keys).alias("k")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.text_hash") == F.col("k.text_hash"))
    texts = near.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", _words(F.col("text")).alias("w"))
    rarest = anchor_rows.join(terms, "term_id").groupBy("window").agg(F.array_sort(F.collect_list(F.struct("r", "offset", "term"))).alias("anchors"))  # RAREST at most
    phrases = stored(windows.join(rarest, "window"), "phrases")
    phrased = found.join(bounded(phrases, phrases.count()), "window")
    pair = F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.text_hash") == F.col("c.text_hash"))
    places = F.sequence(F.col("start"), F.col("start") + (CELL - 1))

    def exact(s: Column) -> Column:
        return (s >= 0) & (F.array_join(F.slice("w", F.greatest(s, F.lit(0)) + 1, F.col("n")), " ") == F.col("phrase"))

    def close(s: Column) -> Column:
        first = F.element_at("anchors", 1)
        others = F.slice("anchors", 2, RAREST)
        near = F.forall(others, lambda a: F.exists(F.sequence(F.lit(-slop), F.lit(slop)), lambda d: F.get("w", s + a["offset"] + d) == a["term"]))
        return F.coalesce(F.get("w", s + first["offset"]) == first["term"], F.lit(False)) & near

    checked = phrased.alias("c").join(texts.alias("t"), pair).select(
        "c.doc_id", "c.text_hash", "window", "n", F.filter(places, exact).alias("starts"), F.exists(places, close).alias("near")
    )
    checked = stored(checked, "matches")
    hits = checked.select("doc_id", "text_hash", F.explode("starts").alias("start"), "window", "n")
    near = checked.where("near").select("doc_id", "text_hash", "window")
    sizes = index.where("term_id = -1").select("doc_id", "text_hash", F.col("position").cast("long").alias("n_words"))
    return sizes, hits, near, items


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated and n_near for
    every document; n_near counts the items of which a window is matched exactly or closely."""
    sizes, hits, near, items = find(docs, benchmark, width)
    # The union of the hit ranges of a document: what each adds beyond the furthest end so far.
    spans = hits.groupBy("doc_id", "text_hash", "start").agg((F.col("start") + F.max("n")).alias("end"))
    before = Window.partitionBy("doc_id", "text_hash").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy("doc_id", "text_hash").agg(F.sum("fresh").cast("long").alias("n_hit"))
    named = hits.select("doc_id", "text_hash", "window").distinct().join(bounded(items, items.count()), "window")
    listed = named.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    close = near.distinct().join(bounded(items, items.count()), "window").groupBy("doc_id", "text_hash").agg(F.countDistinct("item_id").alias("n_near"))
    listed = listed.withColumn("n_near", F.lit(None).cast("long")).unionByName(close.withColumn("items", F.lit(None).cast("array<string>")))
    listed = listed.groupBy("doc_id", "text_hash").agg(F.max("items").alias("items"), F.max("n_near").alias("n_near"))
    s, c, i = sizes.alias("s"), covered.alias("c"), listed.alias("i")
    with_hits = s.join(c, F.col("s.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("s.text_hash") == F.col("c.text_hash")), "left")
    full = with_hits.join(i, F.col("s.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("s.text_hash") == F.col("i.text_hash")), "left")
    names = F.coalesce("items", F.array().cast("array<string>"))
    return full.select(
        "s.doc_id", "s.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, s, occ.n, item_id FROM occ JOIN win USING (phrase, n)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1),
tw AS (SELECT doc_id, unnest(w) AS term, generate_subscripts(w, 1) - 1 AS p FROM d),
f AS (SELECT term, count(*) AS f FROM tw GROUP BY 1),
pt AS (
  SELECT phrase, unnest(string_split(phrase, ' ')) AS term, generate_subscripts(string_split(phrase, ' '), 1) - 1 AS o
  FROM (SELECT DISTINCT phrase FROM win)),
anc AS (
  SELECT phrase, term, o, row_number() OVER (PARTITION BY phrase ORDER BY coalesce(f, 0), o) AS r
  FROM pt LEFT JOIN f USING (term) QUALIFY r <= 3),
need AS (SELECT phrase, count(*) - 1 AS need FROM anc GROUP BY 1),
piv AS (SELECT doc_id, phrase, p - o AS s FROM tw JOIN anc USING (term) WHERE r = 1),
oth AS (
  SELECT piv.doc_id, piv.phrase, s, count(DISTINCT r) AS c
  FROM piv JOIN anc ON anc.phrase = piv.phrase AND r > 1 JOIN tw ON tw.doc_id = piv.doc_id AND tw.term = anc.term AND abs(p - o - s) <= 2
  GROUP BY 1, 2, 3),
clo AS (SELECT DISTINCT doc_id, phrase FROM piv JOIN need USING (phrase) LEFT JOIN oth USING (doc_id, phrase, s) WHERE coalesce(c, 0) = need),
nr AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM clo JOIN win USING (phrase) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN nr USING (doc_id)
"""
