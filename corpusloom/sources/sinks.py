"""Writers of documents and exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import qa


def wrapped_html(title: Column, source: Column, url: Column, author: Column, category: Column, scraped: Column, published: Column, html: Column, text: Column) -> Column:
    """A document as a page of its own."""
    def safe(value: Column) -> Column:
        out = F.coalesce(value, F.lit(""))
        for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            out = F.replace(out, F.lit(sign), F.lit(entity))
        return out

    body = F.when(F.coalesce(html, F.lit("")) != "", html).otherwise(F.concat(F.lit("<p>"), F.replace(safe(text), F.lit("\n"), F.lit("</p><p>")), F.lit("</p>")))

    def meta(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'<meta name="{name}" content="'), safe(value), F.lit('">\n'))

    def span(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'<span class="{name}">'), safe(value), F.lit("</span>\n"))

    return F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n<meta charset="UTF-8">\n'),
        meta("source", source), meta("source-url", url), meta("scraped-date", F.date_format(scraped, "yyyy-MM-dd'T'HH:mm:ss")), meta("author", author), meta("category", category),
        F.lit("<title>"), safe(title), F.lit("</title>\n</head>\n<body>\n<article>\n<h1>"), safe(title), F.lit('</h1>\n<div class="metadata">\n'),
        span("source", source), span("author", author), span("date", published.cast("string")), span("url", url),
        F.lit('</div>\n<div class="content">'), body, F.lit("</div>\n</article>\n</body>\n</html>"),
    )


def joined_tags(tags: Column) -> Column:
    """Tags as one comma-joined value."""
    return F.array_join(tags, ",")


def file_name(scraped: Column, url_hash: Column, title: Column) -> Column:
    return F.concat(F.date_format(scraped, "yyyyMMdd_HHmmss"), F.lit("_"), F.substring(url_hash, 1, 12), F.lit("_"), T.sanitise_filename(title, 80))


def export(pairs: DataFrame, path: str, form: str = "jsonl", chat: bool = False) -> None:
    """Pairs by date and id as JSON lines, or as one JSON array (for sizes one task can hold)."""
    ordered = pairs.orderBy("date_generated", "qa_hash")
    records = qa.chat_records(ordered) if chat else qa.flat_records(ordered)
    if form == "jsonl":
        records.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
        return
    if form != "json":
        raise ValueError(f"unknown form {form}")
    number = F.monotonically_increasing_id()
    rows = records.select(F.struct(*records.columns).alias("r")).withColumn("at", number)
    array = rows.agg(F.array_sort(F.collect_list(F.struct("at", "r"))).alias("a")).select(F.to_json(F.transform("a", lambda x: x["r"])).alias("value"))
    array.coalesce(1).write.mode("overwrite").text(path)
