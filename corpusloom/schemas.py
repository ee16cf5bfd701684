"""Schemas of the engine's own tables; nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _B, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SOURCES = _of(name=_S, source_type=_S, base_url=_S, enabled=_B, priority=_I, scrape_interval_hours=_I)
RAW_ITEM = _of(
    source_name=_S, source_url=_S, page_url=_S, title=_S, content_html=_S, content_text=_S, author=_S, date_published=_TS,
    date_scraped=_TS, category=_S, language=_S, metadata=T.MapType(_S, _S), tags=T.ArrayType(_S),
)
DOCUMENTS = _of(
    id=_S, source_name=_S, url=_S, url_hash=_S, content_hash=_S, title=_S, content_text=_S, language=_S, content_length=_I,
    word_count=_I, quality_score=T.DecimalType(5, 3), is_duplicate=_B, duplicate_of=_S, pipeline_stage=_S, qa_count=_I,
    metadata=_S, tags=_S, date_scraped=_TS, created_at=_TS,
)
QA_PAIRS = _of(id=_S, document_id=_S, qa_hash=_S, question=_S, answer=_S, brand=_S, model=_S, year=_S, category=_S, quality_score=T.DecimalType(5, 3), llm_model=_S, date_generated=_TS)
VISITED = _of(url_hash=_S, url=_S, first_visited=_TS, last_visited=_TS, visit_count=_L, content_hash=_S, has_changed=_B)
SCRAPE_LOGS = _of(round_number=_L, source_name=_S, status=_S, started_at=_TS, completed_at=_TS, items_scraped=_L, errors=_L, duration_seconds=T.DecimalType(10, 2))
ROUNDS = _of(round_number=_L, status=_S, started_at=_TS, completed_at=_TS, items_scraped=_L, items_stored=_L, errors=_L, sources=T.ArrayType(_S))

#: A forum's listing and comment payloads, and a vehicle authority's records.
LISTING = _of(
    data=_of(
        after=_S,
        children=T.ArrayType(_of(data=_of(
            id=_S, permalink=_S, title=_S, selftext=_S, author=_S, created_utc=T.DoubleType(), score=_L, num_comments=_L,
            upvote_ratio=T.DoubleType(), is_self=_B,
        ))),
    )
)
COMMENTS = T.ArrayType(_of(data=_of(children=T.ArrayType(_of(kind=_S, data=_of(author=_S, body=_S, score=_L))))))
STAGES = ("scraped", "stored", "deduplicated", "qa_generated", "qa_skipped", "failed")
