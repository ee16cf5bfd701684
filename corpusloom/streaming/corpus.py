"""A corpus kept by rounds: scraped items and question-answer pairs land in folders, and each
round takes in what is new of both, as committed versions of all tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import changes, gates, qa, upsert
from ..storage import stored
from . import rounds
from .snapshots import Change, Snapshots

#: Landed rows.
ITEMS = "source_name string, url string, content_text string, language string, date_scraped timestamp_ntz"
PAIRS = "document_id string, question string, answer string, llm_model string, date_generated timestamp_ntz"


class Corpus:
    """Tables ``documents``, ``qa_pairs``, ``scrape_log`` and ``rounds`` under one folder.

    Scraping and pairs run side by side as two streams. Pairs are for documents that were
    pending when the round began; a pair whose document changes in the same round is dropped,
    whichever of the two is committed first.
    """

    def __init__(self, spark: SparkSession, path: str, language: str | None = "en", min_pairs: int = 1):
        self.spark, self.path, self.language, self.min_pairs = spark, path.rstrip("/"), language, min_pairs
        self.snapshots = Snapshots(spark, f"{self.path}/tables")

    def table(self, name: str, only: DataFrame | None = None) -> DataFrame:
        """A table as last committed, or its rows with the keys of ``only``."""
        found = self.snapshots.read(name, only=only)
        if found is not None:
            return found
        empty = {"documents": changes.DOCUMENTS, "qa_pairs": "qa_hash string, document_id string, question string, answer string, llm_model string, date_generated timestamp_ntz"}
        return self.spark.createDataFrame([], empty[name])

    def ingest(self, items: DataFrame, batch_id: int, round_number: int) -> bool:
        """One batch of landed items (ITEMS): gated, compared with what is stored, committed."""

        def plan() -> dict[str, Change]:
            url = F.col("url")
            found = items.select("source_name", T.url_hash(url).alias("url_hash"), "content_text", "language", "date_scraped")
            text, length = F.col("content_text"), F.col("content_length")
            wanted = F.col("url_hash").isNotNull() & (F.lit(self.language is None) | F.col("language").eqNullSafe(self.language))
            found = found.withColumn("content_length", F.coalesce(F.length(text), F.lit(0)))
            # Words are counted, contents hashed and texts kept only where they are asked for.
            found = found.withColumn("word_count", F.when(wanted & (length >= gates.MIN_CHARS), T.word_count(text)).otherwise(0))
            found = found.withColumn("admitted", wanted & gates.long_enough(length, F.col("word_count")))
            derived = changes.numbered(found.withColumns({"content_hash": F.when(F.col("admitted"), T.content_hash(text)), "content_text": F.when(F.col("admitted"), text)}))
            admitted = derived.where("admitted")
            made = changes.plan_batch(admitted, self.table("documents"), round_number)
            stale = self.table("qa_pairs").join(made.changed, "document_id", "left_semi").select("qa_hash")
            rejected = derived.where("not admitted").select("source_name", F.lit("rejected").alias("outcome"))
            seen = admitted.select("source_name").withColumn("outcome", F.lit("admitted"))
            outcomes = made.outcomes.select("source_name", "outcome").unionByName(rejected).unionByName(seen)
            log = outcomes.groupBy("source_name").pivot("outcome", ["admitted", "rejected", "stored", "duplicate", "changed", "unchanged", "url_hash"]).count().na.fill(0)
            # Items of one address in one batch count as admitted, and one of them is stored.
            log = log.select(F.lit(round_number).cast("long").alias("round_number"), F.lit(batch_id).cast("long").alias("batch_id"), "source_name", (F.col("admitted") + F.col("rejected")).alias("items"),
                             "rejected", "stored", (F.col("duplicate") + F.col("url_hash")).alias("duplicates"), "changed", "unchanged")
            return {
                "documents": Change(made.documents, key=["id"]), "qa_pairs": Change(self.table("qa_pairs").limit(0), stale, ["qa_hash"]),
                "scrape_log": Change(log, key=None),
            }

        return self.snapshots.commit("scrape", batch_id, plan)

    def add_pairs(self, pairs: DataFrame, batch_id: int, pending: int) -> bool:
        """One batch of landed pairs (PAIRS) for documents pending in version ``pending``: unfit pairs
        go, as do all of a document with fewer than ``min_pairs`` fit ones; hashes already stored
        are passed over, and the documents' counts follow. A document all of whose pairs go is
        skipped from then on."""

        def plan() -> dict[str, Change]:
            then = self.snapshots.read("documents", pending)
            then = self.table("documents").limit(0) if then is None else then
            waiting = gates.eligible(then.withColumn("quality_score", F.lit(None))).select(F.col("id").alias("document_id"), F.col("content_hash").alias("then_hash"))
            # Documents are never deleted, so the others have the content that they had then.
            put = self.snapshots.since("documents", pending)
            put = then if put is None else put
            other = put.select(F.col("id").alias("put_id"), F.col("content_hash").alias("put_hash"))
            fresh = waiting.join(other, (F.col("document_id") == F.col("put_id")) & ~F.col("then_hash").eqNullSafe(F.col("put_hash")), "left_anti").select("document_id")
            asked = stored(pairs.join(fresh, "document_id"), "asked")
            return self._taken(asked.select("document_id").distinct(), asked)

        return self.snapshots.commit("pairs", batch_id, plan)

    def _taken(self, asked: DataFrame, pairs: DataFrame) -> dict[str, Change]:
        """The changes by which the documents ``asked`` (document_id) take in their pairs (PAIRS)."""
        asked = stored(asked, "asked")
        # Whole rows, with their texts, are read of those documents alone.
        now, old = self.table("documents", asked.withColumnRenamed("document_id", "id")), self.table("qa_pairs")
        fit = qa.at_least(qa.acceptable(pairs), self.min_pairs).withColumn("qa_hash", T.qa_hash(F.col("question"), F.col("answer")))
        fit = stored(upsert.insert_if_absent(fit.select(*old.columns), old, "qa_hash", ["document_id", "date_generated"]), "pairs")
        bumped = upsert.bump_parents(now, fit)
        bumped = bumped.withColumn("pipeline_stage", F.when(F.col("qa_count") == 0, "qa_skipped").otherwise(F.col("pipeline_stage")))
        return {"documents": Change(bumped.select(*now.columns), key=["id"]), "qa_pairs": Change(fit, key=["qa_hash"])}

    def answer(self, generator: Callable[[str], str], size: int, model: str = "", concurrency: int | None = None) -> int:
        """One batch of the queue: the ``size`` best of the documents that wait are given to the
        generator, and its replies' pairs are taken in; how many pairs that made. Documents whose
        replies give too few are skipped from then on; those whose call failed wait on."""
        quality = T.content_quality(F.col("content_text"), F.col("word_count"))
        docs = gates.queue(self.table("documents").withColumn("quality_score", quality), size)
        replies = stored(qa.generate(docs, generator, concurrency), "replies").where("status <> 'failed'")
        made = qa.pairs_from_replies(replies).withColumns({"llm_model": F.lit(model), "date_generated": F.current_timestamp().cast("timestamp_ntz")})
        before = self.table("qa_pairs").count()
        self.snapshots.commit("answers", self.snapshots.manifest().applied.get("answers", -1) + 1, lambda: self._taken(replies.select(F.col("id").alias("document_id")), stored(made, "made")))
        return self.table("qa_pairs").count() - before

    def answer_all(self, generator: Callable[[str], str], size: int, model: str = "", concurrency: int | None = None) -> int:
        """Batches of ``answer`` until no document waits or a batch makes no pair; pairs made."""
        return until_settled(lambda: self.answer(generator, size, model, concurrency), self.pending)

    def run_round(self, number: int, items: str, pairs: str, files_per_trigger: int | None = None) -> str:
        """One round over what has landed in two folders of Parquet files since the last; its status.

        A round that fails is kept as ``failed``, and what it committed stays. Run again under its
        number it goes on as of its first beginning.
        """
        began = self._begin(number)
        streams = []
        try:
            for name, folder, schema, commit in (
                ("scrape", items, ITEMS, lambda batch, i: self.ingest(batch, i, number)),
                ("pairs", pairs, PAIRS, lambda batch, i: self.add_pairs(batch, i, began)),
            ):
                stream = rounds.events(self.spark, folder, schema, files_per_trigger)
                checkpoint = f"{self.path}/checkpoints/{name}"
                streams.append(stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
            for s in streams:
                s.awaitTermination()
            status = "completed"
        except Exception:
            for s in streams:
                s.stop()
            self._set_round(number, "failed", began)
            raise
        self._set_round(number, status, began)
        return status

    def _begin(self, number: int) -> int:
        """The version that the round's documents are pending in, noted in its row as it starts."""
        known = self.snapshots.read("rounds")
        rows = [] if known is None else known.where((F.col("round_number") == number) & (F.col("status") != "completed")).select("began").collect()
        began = rows[0].began if rows else self.snapshots.manifest().version
        self._set_round(number, "running", began)
        return began

    def _set_round(self, number: int, status: str, began: int) -> None:
        """The round's row. Its sums are those of its log, committed with the documents."""
        log = self.snapshots.read("scrape_log")
        sums = ("items", "stored", "duplicates", "changed", "unchanged", "rejected")
        row = self.spark.range(1).select(F.lit(number).cast("long").alias("round_number"), F.lit(status).alias("status"), F.lit(began).cast("long").alias("began"))
        if log is None:
            row = row.select("*", *(F.lit(0).cast("long").alias(c) for c in sums), F.lit("").alias("sources"))
        else:
            mine = log.where(F.col("round_number") == number).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums), F.array_join(F.array_sort(F.collect_set("source_name")), ",").alias("sources"))
            row = row.crossJoin(mine)
        self.snapshots.commit("rounds", self.snapshots.manifest().applied.get("rounds", -1) + 1, lambda: {"rounds": Change(row, key=["round_number"])})

    def pending(self) -> int:
        """Documents that wait for pairs."""
        return gates.eligible(self.table("documents").withColumn("quality_score", F.lit(None))).count()


def until_settled(step: Callable[[], int], pending: Callable[[], int], most: int = 1000) -> int:
    """Repeat ``step``, which says how much it got done, until nothing is pending or a step gets
    nothing done; the sum of what was done."""
    done = 0
    for _ in range(most):
        if not pending():
            break
        got = step()
        done += got
        if not got:
            break
    return done
