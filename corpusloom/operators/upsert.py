"""Writes that respect what is there already, as joins (plain files have no MERGE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def insert_if_absent(new: DataFrame, old: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of ``new`` to append: keys not in ``old``; of several with one key, the first."""
    first = new.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    chosen = new.join(first, key).where(F.struct(*order) == F.col("_first")).drop("_first").dropDuplicates([key])
    return chosen.join(old.select(key), key, "left_anti")


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_n", rank).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, key: str, keep_old: tuple[str, ...] = ()) -> DataFrame:
    """All keys of either side; a new value replaces an old one unless it's null or its column
    is in ``keep_old``."""
    a, b = old.alias("a"), new.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")

    def value(c: str) -> Column:
        first, second = (f"a.{c}", f"b.{c}") if c in keep_old else (f"b.{c}", f"a.{c}")
        return F.coalesce(first, second).alias(c)

    return joined.select(*(value(c) for c in old.columns))


def replace_pairs(pairs: DataFrame, changed_documents: DataFrame) -> DataFrame:
    """Pairs without those of documents whose content has changed."""
    return pairs.join(changed_documents.select("document_id"), "document_id", "left_anti")


def bump_parents(docs: DataFrame, inserted: DataFrame, stage: str = "qa_generated") -> DataFrame:
    """Documents with the number of new pairs added to qa_count, and their stage moved on."""
    n = inserted.groupBy(F.col("document_id").alias("id")).agg(F.count("*").alias("_new"))
    out = docs.join(n, "id", "left")
    out = out.withColumn("qa_count", F.col("qa_count") + F.coalesce("_new", F.lit(0)))
    return out.withColumn("pipeline_stage", F.when(F.col("_new") > 0, stage).otherwise(F.col("pipeline_stage"))).drop("_new")


def merge_metadata(metadata: Column, key: str, value: Column) -> Column:
    """A JSON object with one key set; other values keep their types. What isn't an object
    counts as an empty one."""
    kind = "map<string,variant>"
    old = F.coalesce(F.from_json(metadata, kind), F.create_map().cast(kind))
    kept = F.map_filter(old, lambda k, _: k != key)
    return F.to_json(F.map_concat(kept, F.create_map(F.lit(key), value.cast("variant"))))


def start_round(rounds: DataFrame, number: int, at: Column) -> DataFrame:
    """The round's row (round_number, start_time, status) anew or in place, running since ``at``."""
    spark = rounds.sparkSession
    new = spark.range(1).select(F.lit(number).cast(rounds.schema["round_number"].dataType).alias("round_number"), at.alias("start_time"), F.lit("running").alias("status"))
    old = rounds.where(F.col("round_number") == number).drop("start_time", "status")
    row = new.join(old, "round_number", "left").select(*rounds.columns)
    return rounds.where(F.col("round_number") != number).unionByName(row)


def update_round(rounds: DataFrame, number: int, values: dict[str, object]) -> DataFrame:
    """The given columns of one round's row set."""
    mine = F.col("round_number") == number
    return rounds.withColumns({c: F.when(mine, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})
