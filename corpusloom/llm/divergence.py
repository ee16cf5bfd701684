"""How far the sources of a language differ in their vocabulary, by DuckDB over shards of terms.

Terms are runs of ASCII letters and characters beyond ASCII, only A-Z lower-cased. A language
keeps the V terms that stand in at least ``least_docs`` of its documents. For a group (language,
source), and for the language itself, a kept term with ``count`` occurrences there has the weight
``p = 1 + floor(10^9 * (count + 2) / (N + 2 * V))``, N being the count's sum over kept terms. Two
weights differ by ``floor((p - q)^2 / (p + q))``. All of it is integer arithmetic.

1.  Each task counts its documents' terms in SQL, a few megabytes of text at a time. The counts
    are dealt into shards by hash of language and term, so a term's rows meet in one shard: at
    most one for each source and task.
2.  Each shard sums its counts in SQL and drops the terms in too few documents.
3.  Each shard adds up, in SQL, for every two sources that share a term what that changes against
    both of them lacking it, and keeps its first terms of each group. Terms that a group lacks
    all have one weight, so they aren't written out: Spark adds their share from V and from
    the numbers of terms by weight, merges the shards' sums, and ranks.

Edge cases: null text, language and source are ''; a document without terms still makes its group
occur; repeated rows are documents of their own; texts of any length are counted in pieces; equal
values go by UTF-8 order of the item; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import duckdb
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .native import bounded
from .textkit import groups, small_batches, stored, table, utf8_list

LEAST_DOCS, TOP_TERMS = 10, 10
#: Text counted at a time, and rows that a shard takes in before it sums them.
PIECE_BYTES, SHARD_ROWS, GATHERED_ROWS = 4 << 20, 1 << 20, 1 << 16

#: Letters in lower case; every other ASCII byte a blank.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"
_COUNT = """
SELECT lang, source, term, sum(n)::BIGINT AS n, count(*) AS docs
FROM (SELECT lang, source, doc, term, count(*) AS n FROM (SELECT lang, source, doc, unnest(string_split(words, ' ')) AS term FROM texts) WHERE term <> '' GROUP BY ALL)
GROUP BY ALL"""
_SUM = "SELECT lang, source, term, sum(n)::BIGINT AS n, sum(docs)::BIGINT AS docs FROM part GROUP BY ALL"
#: A null source is the language as a whole.
_KEEP = """
WITH whole AS (SELECT lang, term, sum(n)::BIGINT AS n FROM part GROUP BY ALL HAVING sum(docs) >= {least})
SELECT p.lang, p.term, p.source, p.n FROM part p JOIN whole USING (lang, term) UNION ALL SELECT lang, term, NULL, n FROM whole"""
_WEIGHED = """
CREATE OR REPLACE TEMP TABLE weighed AS
SELECT lang, term, source, p, absent, 1 + (1000000000::HUGEINT * (total + 2) // (lang_size + 2 * terms))::BIGINT AS q
FROM (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 2) // (size + 2 * terms))::BIGINT AS p, 1 + 2000000000 // (size + 2 * terms) AS absent,
    sum(n) OVER (PARTITION BY lang, term) AS total
  FROM part)"""
_AUDIT = """
SELECT 'pair' AS part, lang, a.source AS source, b.source AS item, 1::BIGINT AS many,
  sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p) - (a.p - b.absent) * (a.p - b.absent) // (a.p + b.absent)
    - (a.absent - b.p) * (a.absent - b.p) // (a.absent + b.p) + (a.absent - b.absent) * (a.absent - b.absent) // (a.absent + b.absent))::BIGINT AS value
FROM weighed a JOIN weighed b USING (lang, term) WHERE a.source < b.source GROUP BY ALL
UNION ALL SELECT 'alone', lang, source, '', count(*), p FROM weighed GROUP BY ALL
UNION ALL SELECT 'term', lang, source, term, 1, value
FROM (SELECT lang, source, term, (p - q) * (p - q) // (p + q) AS value FROM weighed WHERE p > q)
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, term) <= {top}"""


def _engine() -> duckdb.DuckDBPyConnection:
    """A database in memory for one task; it writes no files."""
    return duckdb.connect(config={"threads": 1, "memory_limit": "500MB", "temp_directory": "", "autoinstall_known_extensions": False})


def _pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at blanks into pieces of about PIECE_BYTES."""
    begin = 0
    while len(text) - begin > PIECE_BYTES:
        cut = text.find(b" ", begin + PIECE_BYTES)
        if cut < 0:
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term) of some documents at a time."""
    con = _engine()

    def counted(lang: pa.Array, source: pa.Array, texts: list[bytes]) -> pa.Table:
        words = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
        con.register("texts", pa.table({"lang": lang, "source": source, "doc": pa.array(range(len(texts)), pa.int64()), "words": words}))
        out = con.sql(_COUNT).to_arrow_table()
        con.unregister("texts")
        return out

    def both(batch: pa.RecordBatch, begin: int, many: int) -> tuple[pa.Array, pa.Array]:
        return batch.column(0).slice(begin, many), batch.column(1).slice(begin, many)

    for batch in batches:
        texts = [t.translate(_PLAIN) for t in utf8_list(batch.column(2))]
        for begin, end in groups(texts, PIECE_BYTES):
            if end - begin > 1 or len(texts[begin]) <= PIECE_BYTES:
                out = counted(*both(batch, begin, end - begin), texts[begin:end])
            else:
                # One long text: its pieces' counts are one document's.
                con.register("part", pa.concat_tables([counted(*both(batch, begin, 1), [p]) for p in _pieces(texts[begin])]))
                out = con.sql("SELECT lang, source, term, sum(n)::BIGINT AS n, 1::BIGINT AS docs FROM part GROUP BY ALL").to_arrow_table()
                con.unregister("part")
            yield from out.to_batches(max_chunksize=1 << 16)


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Small batches put together: a statement costs more than the rows of one."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= GATHERED_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _shard(batches: Iterable[pa.RecordBatch], statements: tuple[str, ...], compact: str | None) -> Iterator[pa.RecordBatch]:
    """``statements`` over a shard's rows as the table ``part``, the last one's result; ``compact``
    shrinks what has come in so far."""
    con = _engine()
    held, summed = 0, 0
    for rows in _gathered(batches):
        con.register("rows", rows)
        con.execute("INSERT INTO part SELECT * FROM rows" if held else "CREATE TABLE part AS SELECT * FROM rows")
        con.unregister("rows")
        held += len(rows)
        if compact and held - summed > max(SHARD_ROWS, summed):
            con.execute(f"CREATE OR REPLACE TABLE part AS {compact}")
            held = summed = con.execute("SELECT count(*) FROM part").fetchall()[0][0]
    if held:
        if compact:
            con.execute(f"CREATE OR REPLACE TABLE part AS {compact}")
        for statement in statements[:-1]:
            con.execute(statement)
        yield from con.sql(statements[-1]).to_arrow_table().to_batches(max_chunksize=1 << 16)


def difference(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two weights."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: for each group the other sources of its language by
    their difference from it (part ``pair``), and the ``top`` terms that it has more of than its
    language (part ``term``)."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = docs.mapInArrow(_count, _COUNTS).repartition(parts, "lang", "term")
    keep = (_KEEP.format(least=least_docs),)
    kept = stored(counts.mapInArrow(lambda x: _shard(x, keep, _SUM), "lang string, term string, source string, n long"), "terms")

    whole = kept.where("source is null").groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_size"))
    sizes = kept.where("source is not null").groupBy("lang", "source").agg(F.sum("n").alias("size"))
    sized = docs.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(whole, "lang", "left")
    sized = stored(sized.na.fill(0, ["size", "terms", "lang_size"]), "groups")
    n_groups = sized.count()

    shards = kept.where("source is not null").join(bounded(sized, n_groups), ["lang", "source"]).select("lang", "term", "source", "n", "size", "terms", "lang_size")
    audit = (_WEIGHED, _AUDIT.format(top=top))
    shards = shards.repartition(parts, "lang", "term")
    found = stored(shards.mapInArrow(lambda x: _shard(x, audit, None), "part string, lang string, source string, item string, many long, value long"), "audit")

    absent = F.expr("if(terms = 0, 1, 1 + (2000000000 div (size + 2 * terms)))")
    mine = sized.select("lang", "source", "terms", absent.alias("absent"))
    other = bounded(mine.select("lang", F.col("source").alias("item"), F.col("absent").alias("other_absent")), n_groups)
    lacking = difference(F.col("absent"), F.col("other_absent"))
    # What all kept terms give if neither has them; then what a term that only one is known to have changes.
    base = mine.join(other, "lang").where("source <> item").select("lang", "source", "item", (F.col("terms") * lacking).alias("value"))
    alone = found.where("part = 'alone'").groupBy("lang", "source", F.col("value").alias("p")).agg(F.sum("many").alias("many"))
    alone = alone.join(bounded(mine, n_groups), ["lang", "source"]).join(other, "lang").where("source <> item")
    alone = alone.select("lang", "source", "item", (F.col("many") * (difference(F.col("p"), F.col("other_absent")) - lacking)).alias("value"))
    one_way = alone.unionByName(found.where("part = 'pair'").select("lang", "source", "item", "value"))
    one_way = one_way.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    back = one_way.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = base.unionByName(one_way).unionByName(back).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    terms = found.where("part = 'term'").select("lang", "source", "item", "value", F.lit("term").alias("part"))
    both = pairs.withColumn("part", F.lit("pair")).unionByName(terms)
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    ranked = both.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top))
    return ranked.select("lang", "source", "part", "item", "value", "rank")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


#: Every kept term is written out for every group: plain, and for small tables.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
o AS (SELECT k, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS nl FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
full_ AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS nl FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, source, sum(n)::BIGINT AS size FROM full_ GROUP BY ALL),
w AS (
  SELECT lang, source, term, f.n, 1 + 1000000000 * (f.n + 2) // (s.size + 2 * v.v) AS p, 1 + 1000000000 * (f.nl + 2) // (v.nl + 2 * v.v) AS q
  FROM full_ f JOIN s USING (lang, source) JOIN v USING (lang)),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM w a JOIN w b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM w WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM terms
QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 10
"""
