"""What lets a document in, and the fields derived on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

MIN_CHARS, MIN_WORDS, MIN_QUALITY = 100, 20, 0.6


def long_enough(length: Column, words: Column) -> Column:
    return (length >= MIN_CHARS) & (words >= MIN_WORDS)


def admit(docs: DataFrame, language: str | None = "en") -> DataFrame:
    """Rows of the wanted language (any if None) that are long enough."""
    kept = docs if language is None else docs.where(F.col("language") == language)
    return kept.where(long_enough(F.col("content_length"), F.col("word_count")))


def within_size(html: Column, megabytes: int) -> Column:
    return F.octet_length(html) <= megabytes * 1024 * 1024


def derive(docs: DataFrame) -> DataFrame:
    """Hash, lengths, counts and the quality estimate of rows with content_text."""
    text = F.col("content_text")
    words = T.word_count(text)
    return docs.withColumns({
        "content_hash": T.content_hash(text), "content_length": F.length(text), "file_size_bytes": F.octet_length(text),
        "word_count": words, "quality_score": T.content_quality(text, words),
    })


def skip_reason(text: Column, source: Column, quality: Column, skip_sources: tuple[str, ...] = (), min_quality: float = MIN_QUALITY) -> Column:
    """Why a document gets no question-answer pairs, the first that holds; null if it may."""
    return (
        F.when(source.isin(*skip_sources) if skip_sources else F.lit(False), "source_skipped")
        .when(F.length(F.coalesce(text, F.lit(""))) < MIN_CHARS, "text_too_short")
        .when(quality < min_quality, "low_quality")
    )


def eligible(docs: DataFrame) -> DataFrame:
    """Documents that wait for pairs."""
    return docs.where(
        F.col("pipeline_stage").isin("stored", "deduplicated", "quality_checked") & ~F.col("is_duplicate") & (F.col("qa_count") == 0)
        & long_enough(F.col("content_length"), F.col("word_count"))
    )


def queue(docs: DataFrame, n: int) -> DataFrame:
    """The next n: best estimate first, then the longest, then by id."""
    return eligible(docs).orderBy(F.col("quality_score").desc_nulls_last(), F.col("content_length").desc(), "id").limit(n)
