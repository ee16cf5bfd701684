"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Only a local session, whose driver is its executor, may leave it unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = f"{tempfile.gettempdir()}/checkpoints"
    return folder.rstrip("/")


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, so a lost
    executor costs no recomputation of what stands before."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            remove(df.sparkSession, file.rpartition("/")[0])


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """What stands in a folder, by name; nothing where there is no such folder."""
    fs, at = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as a whole."""
    fs, at = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file, seen by readers whole or not at all."""
    fs, at = _file_system(spark, path)
    if fs.exists(at):
        raise FileExistsError(path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.part-{uuid.uuid4().hex}")
    stream = fs.create(part, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if not fs.rename(part, at):
        raise FileExistsError(path)
