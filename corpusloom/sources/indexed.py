"""Documents laid out for lookups: sorted by one key, with Bloom filters on others.

A lookup by a list of keys reads only the row groups whose range or filter may hold one of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A longer list is joined as a table.
LISTED = 200
ROW_GROUP_BYTES = 32 << 20


def write(df: DataFrame, path: str, sort_key: str, bloom: tuple[str, ...] = (), files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES, distinct: int = 1_000_000) -> None:
    """``df`` as Parquet in the order of ``sort_key`` (ranges over ``files`` files), with filters for
    about ``distinct`` values a row group on the columns ``bloom``."""
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartitionByRange(files, sort_key).sortWithinPartitions(sort_key).write.mode("errorifexists").option("parquet.block.size", row_group_bytes)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def lookup(table: DataFrame, column: str, keys: list[str] | DataFrame) -> DataFrame:
    """The rows of a table whose ``column`` is one of ``keys``: values, or a table with that column.

    A list of up to LISTED values becomes equalities, which the scan checks against each row
    group; a longer one, or a table, is a semi join.
    """
    if isinstance(keys, DataFrame):
        return table.join(keys.select(column).distinct(), column, "left_semi").select(*table.columns)
    wanted = list(dict.fromkeys(k for k in keys if k is not None))
    if len(wanted) > LISTED:
        return lookup(table, column, table.sparkSession.createDataFrame([(k,) for k in wanted], [column]))
    if not wanted:
        return table.where("false")
    same: list[Column] = [F.col(column) == F.lit(k) for k in wanted]
    return table.where(reduce(Column.__or__, same))


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
