"""Question-answer pairs: from turns or replies, filtered, counted and exported."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.python import parse_pairs, qa_pairs

MIN_PAIRS = 3
CONTEXT_CHARS = 4000


def pairs_from_turns(turns: DataFrame) -> DataFrame:
    """A user turn and the assistant turn right after it: document_id, turn, question, answer."""
    q = turns.where("role = 'user'").select(F.col("conv_id").alias("document_id"), "turn", F.col("text").alias("question"))
    a = turns.where("role = 'assistant'").select(F.col("conv_id").alias("document_id"), (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return q.join(a, ["document_id", "turn"])


def generate(docs: DataFrame, generator: Callable[[str], str], concurrency: int | None = None) -> DataFrame:
    """id, reply and status of an injected generator for each document's cleaned and cut text.

    A failing call gives an empty reply and the status ``failed``. With ``concurrency`` only so
    many tasks run, for a generator that stands no more; prompts are made before, in parallel.
    """
    prompts = docs.select("id", T.truncate(T.strip_noise(F.col("content_text")), CONTEXT_CHARS).alias("prompt"))
    if concurrency is not None:
        prompts = prompts.repartition(concurrency)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def reply(prompt: str) -> tuple[str, str]:
            try:
                return generator(prompt), "done"
            except Exception:
                return "", "failed"

        for batch in batches:
            yield pd.DataFrame([(i, *reply(p)) for i, p in zip(batch["id"], batch["prompt"], strict=True)], columns=["id", "reply", "status"])

    return prompts.mapInPandas(run, f"id {prompts.schema['id'].dataType.simpleString()}, reply string, status string")


def results(replies: DataFrame, least: int = MIN_PAIRS) -> DataFrame:
    """id, status and pairs of each reply: failed, skipped (fewer acceptable pairs than
    ``least``, none of which count) or generated."""
    kept = F.filter(qa_pairs("reply"), lambda p: T.acceptable_question(p["question"]) & T.acceptable_answer(p["answer"]))
    n = replies.select("id", "status", F.size(kept).alias("n"))
    status = F.when(F.col("status") == "failed", "failed").when(F.col("n") < least, "skipped").otherwise("generated")
    return n.select("id", status.alias("status"), F.when(status == "generated", F.col("n")).otherwise(0).alias("pairs"))


def pairs_from_replies(replies: DataFrame) -> DataFrame:
    """One row for each acceptable pair of each reply: document_id, question, answer."""
    out = replies.select(F.col("id").alias("document_id"), F.explode(qa_pairs("reply")).alias("p")).select("document_id", "p.question", "p.answer")
    return acceptable(out)


def acceptable(pairs: DataFrame) -> DataFrame:
    return pairs.where(T.acceptable_question(F.col("question")) & T.acceptable_answer(F.col("answer")))


def at_least(pairs: DataFrame, least: int = MIN_PAIRS) -> DataFrame:
    """Only the pairs of documents that have ``least`` of them or more."""
    enough = pairs.groupBy("document_id").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("document_id")
    return pairs.join(enough, "document_id", "left_semi")


def capped(pairs: DataFrame, most: int) -> DataFrame:
    """The first ``most`` pairs of each document by hash; an option, off by default."""
    rank = F.row_number().over(Window.partitionBy("document_id").orderBy("qa_hash"))
    return pairs.withColumn("_n", rank).where(F.col("_n") <= most).drop("_n")


def annotate(pairs: DataFrame) -> DataFrame:
    """Adds qa_hash, brand, model and year."""
    text = F.concat_ws(" ", "question", "answer")
    out = pairs.withColumn("qa_hash", T.qa_hash(F.col("question"), F.col("answer"))).withColumn("brand", T.vehicle_brand(text))
    return out.withColumn("model", T.vehicle_model(text, F.col("brand"))).withColumn("year", T.vehicle_year(text))


def stats(pairs: DataFrame) -> DataFrame:
    return pairs.agg(
        F.count("*").alias("total"),
        F.round(F.avg(F.length("question"))).cast("int").alias("avg_question"),
        F.round(F.avg(F.length("answer"))).cast("int").alias("avg_answer"),
        F.bround(F.avg(F.col("quality_score").cast("double")), 3).alias("avg_quality"),
    )


def by_value(pairs: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts by a column, empty as (unknown); the commonest ``top`` if given."""
    value = F.coalesce(F.expr(f"nullif({column}, '')"), F.lit("(unknown)"))
    out = pairs.groupBy(value.alias(column)).agg(F.count("*").alias("n"))
    return out if top is None else out.orderBy(F.col("n").desc(), column).limit(top)


def flat_records(pairs: DataFrame) -> DataFrame:
    """The flat export record."""
    return pairs.select(
        "question", "answer", F.coalesce("source_name", F.lit("")).alias("source"), "brand", "model", "year",
        F.col("quality_score").cast("double").alias("quality_score"), "llm_model",
    )


def chat_records(pairs: DataFrame, *keep: str) -> DataFrame:
    """The chat export record: messages of user and assistant, after the columns ``keep``."""

    def message(role: str, column: str):  # noqa: ANN202
        return F.struct(F.lit(role).alias("role"), F.col(column).alias("content"))

    return pairs.select(*keep, F.array(message("user", "question"), message("assistant", "answer")).alias("messages"))


@F.udtf(returnType="question string, answer string, status string")
class ReplyPairs:
    """The rows of one reply, for lateral use: each pair with the status ``kept`` or ``unfit``; one
    row ``empty`` for a reply without pairs, and one ``failed`` for a failed call."""

    def eval(self, reply: str, status: str) -> Iterator[tuple[str | None, str | None, str]]:
        if status == "failed":
            yield None, None, "failed"
            return
        found = parse_pairs(reply)
        for question, answer in found:
            yield question, answer, "kept" if fit(question, answer) else "unfit"
        if not found:
            yield None, None, "empty"


_LEAK = re.compile(rf"\b({'|'.join(T.LEAKS)})\b", re.I | re.A)


def fit(question: str, answer: str) -> bool:
    """``acceptable`` for one pair."""
    return len(question) >= T.MIN_QUESTION and not _LEAK.search(question) and len(answer.strip()) > T.MIN_ANSWER


def reply_rows(replies: DataFrame) -> DataFrame:
    """``replies`` (id, reply, status) with the rows of ``ReplyPairs`` beside them: id, question,
    answer, status."""
    rows = ReplyPairs(F.col("reply").outer(), F.col("status").outer())
    return replies.select("id", "reply", "status").lateralJoin(rows.alias("r")).select("id", "r.question", "r.answer", "r.status")


def outcomes(rows: DataFrame) -> DataFrame:
    """Replies and pairs by status over ``reply_rows``."""
    return rows.groupBy("status").agg(F.countDistinct("id").alias("replies"), F.count("question").alias("pairs"))
