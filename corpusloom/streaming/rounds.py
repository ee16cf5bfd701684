"""Rounds as Structured Streaming: one ``availableNow`` trigger is one round, and the
checkpoint is the high-water mark that survives a restart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, path: str, schema: str | T.StructType = EVENTS, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a Parquet file or folder. A file is read through its folder."""
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(fs_path).isFile():
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def first_seen(stream: DataFrame, key: list[str], ts: str = "ts", ttl: str = "24 hours") -> DataFrame:
    """The first row of each key; a key is forgotten ``ttl`` after it was seen."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(key)


def daily_totals(stream: DataFrame, ts: str = "ts", late: str = "2 days") -> DataFrame:
    """Counts and sums by day and type; a late row updates its day while the watermark allows."""
    w = F.window(F.col(ts), "1 day")
    out = stream.withWatermark(ts, late).groupBy(w, "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.col("window.start").alias("day"), "event_type", "n", "total")


def sessions(stream: DataFrame, key: str, ts: str = "ts", gap: str = "180 seconds", late: str = "180 seconds") -> DataFrame:
    """Runs of beats of a key: started, last_beat and beats. A beat more than ``gap`` after the
    one before begins another run.

    In append mode a run comes out, and is forgotten, once the watermark (the newest beat less
    ``late``) has passed its last beat by ``gap``; a beat that is older than the watermark of its
    batch is dropped.
    """
    runs = stream.withWatermark(ts, late).groupBy(F.session_window(F.col(ts), gap).alias("w"), key)
    return runs.agg(F.min(ts).alias("started"), F.max(ts).alias("last_beat"), F.count("*").alias("beats")).select(key, "started", "last_beat", "beats")


def run_round(stream: DataFrame, commit: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Everything that has landed since the last round, given to ``commit`` in batches."""
    q = stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """One round into a Parquet folder; results that change are overwritten as a whole."""
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        return q

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    q = stream.writeStream.foreachBatch(replace).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def newer_than(df: DataFrame, since: Column) -> DataFrame:
    """Rows past a high-water mark, for batch callers that keep their own."""
    return df.where(F.col("created_at") > since)


def enough(docs: DataFrame, least: int = 100) -> bool:
    """Whether there are so many unique documents; reads no more than it needs."""
    return docs.where(~F.col("is_duplicate")).limit(least).count() >= least
