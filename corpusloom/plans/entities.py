"""The engine's entities projected from the benchmark tables, in DataFrame and in SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedup, qa

DAY0 = "2024-01-01 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, source_name, content_text, language, content_length, word_count, content_hash, date_scraped."""
    text = F.col("text")
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), F.col("doc_id").cast("int"))
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("source_name"), text.alias("content_text"), F.col("lang").alias("language"),
        F.length(text).cast("long").alias("content_length"), T.word_count(text).cast("long").alias("word_count"), T.content_hash(text).alias("content_hash"),
        (F.lit(DAY0).cast("timestamp_ntz") + minutes).alias("date_scraped"),
    )


DOCUMENTS = r"""docs AS (
  SELECT doc_id AS id, source AS source_name, text AS content_text, lang AS language, length(text) AS content_length,
    len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''))::BIGINT AS word_count, sha256(text) AS content_hash,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(doc_id) AS date_scraped
  FROM documents)"""


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with exact duplicates marked and a number of pairs from ``conversations``."""
    docs = dedup.exact(documents(spark, sf_dir))
    n = pairs(spark, sf_dir).groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias("qa_count"))
    return docs.join(n, "id", "left").withColumn("qa_count", F.coalesce("qa_count", F.lit(0)))


MARKED = """first AS (SELECT content_hash, min(id) AS first_id FROM docs GROUP BY 1),
qn AS (SELECT document_id AS id, count(*) AS n FROM pairs GROUP BY 1),
marked AS (
  SELECT docs.*, first_id <> docs.id AS is_duplicate, CASE WHEN first_id <> docs.id THEN first_id END AS duplicate_of, coalesce(n, 0)::BIGINT AS qa_count
  FROM docs JOIN first USING (content_hash) LEFT JOIN qn ON qn.id = docs.id)"""


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four in five of the sources seen, with settings that follow from their numbers."""
    n = F.substring("name", 4, 10).cast("int")
    names = read(spark, sf_dir, "documents").select(F.col("source").alias("name")).distinct().where(n % 5 != 0)
    return names.select("name", (n % 3 != 0).alias("enabled"), (n % 10 + 1).cast("long").alias("priority"))


ROSTER = """num AS (SELECT DISTINCT source AS name, substr(source, 4)::INT AS n FROM documents),
roster AS (SELECT name, n % 3 <> 0 AS enabled, (n % 10 + 1)::BIGINT AS priority FROM num WHERE n % 5 <> 0)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question-answer pairs of the conversations' adjacent turns."""
    found = qa.pairs_from_turns(read(spark, sf_dir, "conversations"))
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.col("document_id").cast("int"), F.col("turn").cast("decimal(18,6)"))
    return found.withColumns({
        "qa_hash": T.qa_hash(F.col("question"), F.col("answer")), "date_generated": F.lit(DAY0).cast("timestamp_ntz") + seconds,
        "llm_model": F.concat(F.lit("model-"), (F.col("document_id") % 3).cast("string")), "quality_score": (F.length("answer") % 100) / 100.0,
        "source_name": F.concat(F.lit("src"), (F.col("document_id") % 20).cast("string")),
        "brand": F.when(F.col("document_id") % 4 == 0, "").otherwise(F.concat(F.lit("brand"), (F.col("document_id") % 18).cast("string"))),
    })


PAIRS = """pairs AS (
  SELECT u.conv_id AS document_id, u.turn, u.text AS question, a.text AS answer, sha256(u.text || '|' || a.text) AS qa_hash,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(u.conv_id) + to_seconds(u.turn) AS date_generated,
    'model-' || (u.conv_id % 3) AS llm_model, (length(a.text) % 100) / 100.0::DOUBLE AS quality_score, 'src' || (u.conv_id % 20) AS source_name,
    CASE WHEN u.conv_id % 4 = 0 THEN '' ELSE 'brand' || (u.conv_id % 18) END AS brand
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"""


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape logs: a round is a day, a source an event type."""
    bad = F.col("event_type") == "error"
    return read(spark, sf_dir, "events").select(
        "event_id", F.dayofmonth("ts").cast("long").alias("round_number"), F.col("event_type").alias("source_name"), F.col("ts").alias("started_at"),
        F.when(bad, 0).otherwise(F.floor("value")).cast("long").alias("items_scraped"), bad.cast("long").alias("errors"),
    )


LOGS = """logs AS (
  SELECT event_id, day(ts)::BIGINT AS round_number, event_type AS source_name, ts AS started_at,
    CASE WHEN event_type = 'error' THEN 0 ELSE floor(value) END::BIGINT AS items_scraped, (event_type = 'error')::BIGINT AS errors
  FROM events)"""


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", "ts", F.col("user_id").cast("string").alias("url_hash"), F.col("event_type").alias("content_hash"))
