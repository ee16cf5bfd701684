"""What a batch of scraped items does to the stored documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import stored
from . import dedup

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampNTZType()
#: A document's id is its url_hash; hi and lo are its fingerprint.
DOCUMENTS = T.StructType([
    T.StructField(n, t) for n, t in {
        "id": _S, "source_name": _S, "content_hash": _S, "content_text": _S, "content_length": _L, "word_count": _L, "hi": _L, "lo": _L, "is_duplicate": _B,
        "duplicate_of": _S, "method": _S, "pipeline_stage": _S, "qa_count": _L, "created_at": _TS, "date_scraped": _TS, "round_number": _L,
    }.items()
])
ITEM = ("source_name", "url_hash", "content_text", "content_hash", "content_length", "word_count", "date_scraped")


@dataclass
class Plan:
    """``documents``: the rows to put; ``changed``: document_id of those whose pairs are stale;
    ``outcomes``: source_name, outcome, method of every item."""

    documents: DataFrame
    changed: DataFrame
    outcomes: DataFrame


def numbered(items: DataFrame) -> DataFrame:
    """The items as a stored table in which each has a number of its own, ``item``."""
    return stored(items.withColumn("item", F.monotonically_increasing_id()), "items")


def latest_items(items: DataFrame) -> DataFrame:
    """One item for each address: the last scraped (of several at one time the largest hash)."""
    last = F.max_by(F.struct(*(c for c in items.columns if c != "url_hash")), F.struct("date_scraped", "content_hash"))
    return items.groupBy("url_hash").agg(last.alias("i")).select("url_hash", "i.*")


def plan_batch(items: DataFrame, documents: DataFrame, round_number: int, max_hamming: int = dedup.MAX_HAMMING) -> Plan:
    """``items`` (ITEM, admitted ones) against ``documents``, as sets and in this order:

    - an address stored as an original: with its content ``unchanged``, else ``changed``: text,
      hash and fingerprint are replaced in place, pairs go, the document queues again;
    - an address stored as a duplicate: ``url_hash``, nothing is stored;
    - a new address: a duplicate of the oldest original with its content (``exact_hash``), as
      the originals are after the changes, or of the first such item of the batch; else of the
      oldest similar original, else the first similar new item before it (``simhash``); else
      ``unique``. Duplicates are recorded without their text.

    Items with a null address are left out. Texts stay in the table of items (``numbered``, which
    is done here unless it was before) until the documents to put are written.
    """
    items = items if "item" in items.columns else numbered(items)
    one = latest_items(items.where("url_hash is not null").select(*(c for c in ITEM if c != "content_text"), "item"))
    # Read several times below, and put together from all parts of the table.
    documents = stored(documents.select("id", "content_hash", "is_duplicate", "created_at", "hi", "lo"), "known")
    old = documents.select(F.col("id").alias("url_hash"), F.col("content_hash").alias("old_hash"), F.col("is_duplicate").alias("old_duplicate"), F.col("created_at").alias("old_created"))
    outcome = (
        F.when(F.col("old_duplicate").isNull(), "new").when(F.col("old_duplicate"), "url_hash")
        .when(F.col("old_hash").eqNullSafe(F.col("content_hash")), "unchanged").otherwise("changed")
    )
    met = stored(one.join(old, "url_hash", "left").withColumn("outcome", outcome), "met")

    changed = met.where("outcome = 'changed'")
    facts = ("id", "content_hash", "created_at")
    kept = documents.where("not is_duplicate").select(*facts, "hi", "lo").join(changed.select(F.col("url_hash").alias("id")), "id", "left_anti")
    renewed = changed.select(F.col("url_hash").alias("id"), "content_hash", F.col("old_created").alias("created_at"), "item")
    by_hash = kept.select(*facts).unionByName(renewed.select(*facts)).groupBy("content_hash").agg(F.min(F.struct("created_at", "id")).alias("known"))
    new = met.where("outcome = 'new'").select(F.col("url_hash").alias("id"), "content_hash", F.col("date_scraped").alias("created_at"), "item")
    found = dedup.first_of(new, "content_hash", ["created_at"]).join(by_hash, "content_hash", "left")
    same = F.coalesce("known.id", F.when(F.col("first_id") != F.col("id"), F.col("first_id")))
    found = stored(found.select("id", "created_at", "item", same.alias("same")), "found")

    # Fingerprints of what may be stored with its text; exact copies need none.
    rest = found.where("same is null")
    asked = rest.select("item").unionByName(renewed.select("item"))
    prints = stored(dedup.fingerprints(items.select(F.col("item").alias("id"), "content_text").join(asked.withColumnRenamed("item", "id"), "id", "left_semi")).withColumnRenamed("id", "item"), "prints")
    after = kept.unionByName(renewed.join(prints, "item", "left").select(*facts, "hi", "lo"))
    near = dedup.oldest_similar(rest.select("id", "created_at", "item").join(prints, "item"), after.where("hi is not null").select("id", "created_at", "hi", "lo"), max_hamming, among=True)
    new = found.select("id", "same").join(near, "id", "left").select(
        F.col("id").alias("url_hash"), F.coalesce("same", "older_id").alias("duplicate_of"),
        F.when(F.col("same").isNotNull(), "exact_hash").when(F.col("older_id").isNotNull(), F.format_string("simhash(%.3f)", 1 - F.col("distance") / dedup.BITS)).otherwise("unique").alias("method"),
    )
    out = stored(met.join(new, "url_hash", "left").join(prints, "item", "left"), "outcomes")

    duplicate = F.col("duplicate_of").isNotNull()
    is_new = F.col("outcome") == "new"

    def unless(value: Column | str) -> Column:
        return F.when(~duplicate, F.col(value) if isinstance(value, str) else value)

    put = out.where("outcome in ('new', 'changed')")
    put = items.select("item", "content_text").join(put.where(~duplicate), "item").unionByName(put.where(duplicate), allowMissingColumns=True)
    rows = put.select(
        F.col("url_hash").alias("id"), "source_name", "content_hash", unless("content_text").alias("content_text"), unless("content_length").alias("content_length"),
        unless("word_count").alias("word_count"), unless("hi").alias("hi"), unless("lo").alias("lo"), duplicate.alias("is_duplicate"), "duplicate_of",
        F.coalesce("method", F.lit("changed")).alias("method"), F.when(is_new, "deduplicated").otherwise("stored").alias("pipeline_stage"), F.lit(0).alias("qa_count"),
        F.coalesce("old_created", "date_scraped").alias("created_at"), "date_scraped", F.lit(round_number).alias("round_number"),
    )
    what = F.when(is_new, F.when(duplicate, "duplicate").otherwise("stored")).otherwise(F.col("outcome"))
    return Plan(rows.select(*(F.col(f.name).cast(f.dataType) for f in DOCUMENTS)), changed.select(F.col("url_hash").alias("document_id")), out.select("source_name", what.alias("outcome"), "method"))
