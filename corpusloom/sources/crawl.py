"""A bounded crawl over landed pages: which pages each round takes, and what waits for the next.

Every source has its own frontier. A round takes, for each source, its first waiting addresses
(nearest to a start address first, then by place on the page, then by address), reads the links
of their pages, and adds those that the source hasn't met. The frontier is a keyed table that is
committed once a round and holds a row for each (source, address), so a crawl goes on where it
stopped; a round reads only the pages that it takes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import stored
from ..streaming.snapshots import Change, Snapshots

FRONTIER = "source string, url string, depth long, position long, found long, taken long"


class Crawl:
    """``frontier`` has source, url, depth (links from a start), position, found and taken: the
    rounds in which an address was met and read (null: waiting)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.snapshots = spark, Snapshots(spark, path)

    def frontier(self) -> DataFrame:
        found = self.snapshots.read("frontier")
        return self.spark.createDataFrame([], FRONTIER) if found is None else found

    def start(self, starts: DataFrame) -> None:
        """Start addresses (source, url, position); those already met are passed over."""

        def plan() -> dict[str, Change]:
            first = starts.groupBy("source", "url").agg(F.min("position").cast("long").alias("position"))
            new = first.join(self.frontier(), ["source", "url"], "left_anti")
            empty = F.lit(None).cast("long")
            return {"frontier": Change(new.select("source", "url", F.lit(0).cast("long").alias("depth"), "position", F.lit(0).cast("long").alias("found"), empty.alias("taken")), key=["source", "url"])}

        self.snapshots.commit("start", self.snapshots.manifest().applied.get("start", -1) + 1, plan)

    def waiting(self) -> DataFrame:
        return self.frontier().where("taken is null")

    def round(self, number: int, pages: DataFrame, links: Column, per_source: int | None = None, max_depth: int | None = None) -> DataFrame:
        """The rows that this round takes, at most ``per_source`` of each source.

        ``pages`` has url; ``links`` is an expression over its columns, an array of addresses in
        their order on the page, computed only for the pages that are taken. Addresses without a
        page are taken as well and lead nowhere. A round done again under its number changes
        nothing. Links from pages at ``max_depth`` aren't followed.
        """

        def plan() -> dict[str, Change]:
            known = self.frontier()
            due = known.where("taken is null")
            if per_source is not None:
                rank = F.row_number().over(Window.partitionBy("source").orderBy("depth", "position", "url"))
                due = due.withColumn("_n", rank).where(F.col("_n") <= per_source).drop("_n")
            due = stored(due.withColumn("taken", F.lit(number).cast("long")), "due")
            follow = due if max_depth is None else due.where(F.col("depth") < max_depth)
            read = follow.select("source", F.col("url").alias("from"), "depth").join(pages.withColumnRenamed("url", "_url"), F.col("from") == F.col("_url"))
            met = read.select("source", "from", (F.col("depth") + 1).alias("depth"), F.posexplode(links).alias("position", "url")).where("url is not null and url <> from")
            first = met.groupBy("source", "url").agg(F.min(F.struct("depth", F.col("position").cast("long").alias("position"))).alias("f"))
            new = first.join(known.select("source", "url"), ["source", "url"], "left_anti")
            new = new.select("source", "url", "f.depth", "f.position", F.lit(number).cast("long").alias("found"), F.lit(None).cast("long").alias("taken"))
            return {"frontier": Change(due.unionByName(new), key=["source", "url"])}

        self.snapshots.commit("round", number, plan)
        return self.frontier().where(F.col("taken") == number)

    def run(self, pages: DataFrame, links: Column, rounds: int, per_source: int | None = None, max_depth: int | None = None) -> int:
        """Up to so many further rounds, as long as anything waits; the number of the last one."""
        last = self.snapshots.manifest().applied.get("round", 0)
        for number in range(last + 1, last + rounds + 1):
            if self.waiting().isEmpty():
                break
            self.round(number, pages, links, per_source, max_depth)
            last = number
        return last
