"""A corpus pipeline: quality, near duplicates, decontamination, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's result to the shared folder as Parquet
and gives it to the next stage, so a lost executor never costs more than one stage.

What each stage does to odd rows: a null or blank text has no votes for it and goes in the
quality stage; repeated rows are one document after near-dedup; an empty table passes
through; columns beyond those the stages use are kept until the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.decontamination import contamination
from corpusloom.llm.neardup import deduplicate
from corpusloom.llm.pii import sanitise
from corpusloom.llm.quality import reject
from corpusloom.llm.sentencepiece_stream import encode_documents
from corpusloom.llm.textkit import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return reject(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles, one stays."""
    return deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    found = contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash"))
    same = docs.doc_id.eqNullSafe(found.bad_id) & (F.xxhash64(docs.text) == found.bad_hash)
    return docs.join(found, same, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are replaced by placeholders."""
    clean = sanitise(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and round_trip."""
    return encode_documents(docs).drop("text")


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokenise", tokenise),
]

#: Neither the classifier nor the encoder can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
