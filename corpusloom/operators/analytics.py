"""Counts, rollups, trends, search and schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded(value: int, low: int, high: int) -> int:
    return max(low, min(high, value))


def overview(docs: DataFrame, pairs: DataFrame, logs: DataFrame, roster: DataFrame) -> DataFrame:
    """One row of global counts: one pass over each table instead of a query per figure."""
    d = docs.agg(
        F.count("*").alias("total_documents"), F.count_if(~F.col("is_duplicate")).alias("unique_documents"),
        F.count_if(F.col("is_duplicate")).alias("duplicates"), F.countDistinct("source_name").alias("sources_seen"),
        F.count_if(~F.col("is_duplicate") & (F.col("qa_count") == 0)).alias("pending_qa"), F.max("date_scraped").alias("last_scraped"),
    )
    q = pairs.agg(F.count("*").alias("total_qa"))
    s = logs.agg(F.count_if(F.col("errors") > 0).alias("failed_runs"))
    r = roster.agg(F.count_if("enabled").alias("sources_enabled"))
    return d.crossJoin(q).crossJoin(s).crossJoin(r)


def per_source(docs: DataFrame) -> DataFrame:
    unique = (~F.col("is_duplicate")).cast("int")
    return docs.groupBy("source_name").agg(
        F.count("*").alias("total"), F.sum(unique).alias("unique_docs"), F.sum("qa_count").alias("qa_total"), F.max("date_scraped").alias("last_scraped")
    )


def roster_stats(roster: DataFrame, docs: DataFrame) -> DataFrame:
    """Every source of the roster with its counts, zero if it has none, by priority and name."""
    joined = roster.join(per_source(docs), roster.name == F.col("source_name"), "left").drop("source_name")
    zero = joined.fillna(0, ["total", "unique_docs", "qa_total"])
    return zero.withColumn("status", F.when(F.col("total") > 0, "active").otherwise("idle")).orderBy("priority", "name")


def distribution(docs: DataFrame, roster: DataFrame) -> DataFrame:
    """Documents by source; sources that left the roster are (removed). Aggregated first, so the
    join is over sources."""
    counts = docs.groupBy("source_name").agg(F.count("*").alias("n"))
    named = counts.join(roster.select("name"), F.col("source_name") == F.col("name"), "left")
    return named.groupBy(F.coalesce("name", F.lit("(removed)")).alias("source")).agg(F.sum("n").alias("n"))


def daily(docs: DataFrame, pairs: DataFrame, start: str, days: int) -> DataFrame:
    """For each day from ``start``: unique, duplicate and pair counts, zero where there are none."""
    day = F.sequence(F.lit(start).cast("date"), F.date_add(F.lit(start).cast("date"), days - 1))
    spine = docs.sparkSession.range(1).select(F.explode(day).alias("day"))
    d = docs.groupBy(F.to_date("date_scraped").alias("day")).agg(F.count_if(~F.col("is_duplicate")).alias("unique_docs"), F.count_if(F.col("is_duplicate")).alias("duplicates"))
    q = pairs.groupBy(F.to_date("date_generated").alias("day")).agg(F.count("*").alias("qa_pairs"))
    return spine.join(d, "day", "left").join(q, "day", "left").fillna(0)


def search(df: DataFrame, equals: dict[str, object], contains: tuple[tuple[str, ...], str] | None = None, extra: Column | None = None) -> DataFrame:
    """Rows that meet all the conditions given; those that are None are left out. ``contains``:
    columns any of which must hold the pattern, case aside (% and _ are wildcards)."""
    for column, value in equals.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    if contains is not None and contains[1]:
        some = F.lit(False)
        for column in contains[0]:
            some = some | F.col(column).ilike(f"%{contains[1]}%")
        df = df.where(some)
    return df if extra is None else df.where(extra)


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    number, size = max(1, number), bounded(size, 1, 200)
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_count(df: DataFrame, size: int) -> DataFrame:
    return df.agg(F.count("*").alias("total"), F.ceil(F.count("*") / F.lit(size)).cast("long").alias("total_pages"))


def last_attempts(logs: DataFrame) -> DataFrame:
    """The last try and the last success of each source."""
    return logs.groupBy("source_name").agg(F.max("started_at").alias("last_try"), F.max(F.when(F.col("items_scraped") > 0, F.col("started_at"))).alias("last_success"))


def schedule(roster: DataFrame, logs: DataFrame, as_of: Column, retry_hours: int = 1) -> DataFrame:
    """When each enabled source is due: at once if never tried; an interval after a success; an
    hour after a failure. Adds is_due and the whole minutes to wait."""
    joined = roster.where("enabled").join(last_attempts(logs), F.col("name") == F.col("source_name"), "left").drop("source_name")
    after = F.make_dt_interval(F.lit(0), F.col("scrape_interval_hours"))
    due = F.when(F.col("last_try").isNull(), as_of).when(F.col("last_success") == F.col("last_try"), F.col("last_try") + after)
    due = due.otherwise(F.col("last_try") + F.make_dt_interval(F.lit(0), F.lit(retry_hours)))
    out = joined.withColumn("next_due", due).withColumn("is_due", as_of >= F.col("next_due"))
    wait = (F.unix_micros(F.col("next_due").cast("timestamp")) - F.unix_micros(as_of.cast("timestamp"))) / 60e6
    return out.withColumn("wait_minutes", F.greatest(F.lit(0), F.floor(wait)).cast("long"))


def visited(visits: DataFrame) -> DataFrame:
    """The state of each URL: first and last visit, visits, last hash, and whether the last visit
    found another hash than the one before."""
    before = visits.groupBy("url_hash").agg(
        F.min("ts").alias("first_visited"), F.max("ts").alias("last_visited"), F.count("*").alias("visit_count"),
        F.max_by("content_hash", F.struct("ts", "event_id")).alias("content_hash"), F.max(F.struct("ts", "event_id")).alias("top"),
    )
    rest = visits.join(before.select("url_hash", "top"), "url_hash").where(F.struct("ts", "event_id") < F.col("top"))
    second = rest.groupBy("url_hash").agg(F.max_by("content_hash", F.struct("ts", "event_id")).alias("previous"), F.count("*").alias("older"))
    out = before.drop("top").join(second, "url_hash", "left")
    changed = (F.col("older").isNotNull()) & ~F.col("previous").eqNullSafe(F.col("content_hash"))
    return out.withColumn("has_changed", changed).drop("previous", "older")


def rounds(logs: DataFrame) -> DataFrame:
    """Sums of each round and the sources it reached."""
    return logs.groupBy("round_number").agg(
        F.sum("items_scraped").alias("items"), F.sum("errors").alias("errors"), F.array_join(F.array_sort(F.collect_set("source_name")), ",").alias("sources"),
        F.min("started_at").alias("started_at"), F.max("started_at").alias("last_seen"),
    )


def live_round(logs: DataFrame, number: int | None = None) -> DataFrame:
    """Counts of one round, the newest unless a number is given."""
    if number is None:
        newest = logs.agg(F.max("round_number").alias("round_number"))
        logs = logs.join(F.broadcast(newest), "round_number")
    else:
        logs = logs.where(F.col("round_number") == number)
    return logs.agg(
        F.count("*").alias("documents"), F.sum("errors").alias("errors"), F.countDistinct("source_name").alias("sources"), F.max("started_at").alias("last_seen")
    )


def repair_rounds(rounds_: DataFrame, current: int) -> DataFrame:
    """Rounds other than the current one that still say running were interrupted."""
    stale = (F.col("status") == "running") & (F.col("round_number") != current)
    return rounds_.withColumn("status", F.when(stale, "interrupted").otherwise(F.col("status")))


def log_status(items: Column, errors: Column) -> Column:
    return F.when((errors > 0) & (items == 0), "failed").otherwise("success")


def heartbeat(beats: DataFrame, as_of: Column, seconds: int = 180) -> DataFrame:
    """The last beat of each mode, its age, and whether it's alive."""
    out = beats.groupBy("mode").agg(F.max("ts").alias("last_beat"))
    age = F.unix_timestamp(as_of) - F.unix_timestamp("last_beat")
    return out.withColumn("age_seconds", age).withColumn("alive", age <= seconds)


def log_tail(lines: DataFrame, n: int) -> DataFrame:
    """The last n lines of a text file read as one split, in order."""
    n = bounded(n, 10, 2000)
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    return numbered.orderBy(F.col("line").desc()).limit(n).orderBy("line")


def fold_visits(state: DataFrame, visits: DataFrame) -> DataFrame:
    """The state of each URL after a batch of later visits: what ``visited`` would give over
    all of them. For use from a stream's batches."""
    last = visited(visits)
    first = visits.groupBy("url_hash").agg(F.min_by("content_hash", F.struct("ts", "event_id")).alias("first_hash"))
    new = last.join(first, "url_hash")
    s, n = state.alias("s"), new.alias("n")
    joined = s.join(n, F.col("s.url_hash") == F.col("n.url_hash"), "full")
    # With one visit in the batch, the visit before it is the state's last one.
    across = ~F.col("s.content_hash").eqNullSafe(F.col("n.first_hash"))
    changed = (
        F.when(F.col("n.url_hash").isNull(), F.col("s.has_changed"))
        .when(F.col("s.url_hash").isNotNull() & (F.col("n.visit_count") == 1), across)
        .otherwise(F.col("n.has_changed"))
    )
    return joined.select(
        F.coalesce("s.url_hash", "n.url_hash").alias("url_hash"), F.coalesce("s.first_visited", "n.first_visited").alias("first_visited"),
        F.coalesce("n.last_visited", "s.last_visited").alias("last_visited"), (F.coalesce("s.visit_count", F.lit(0)) + F.coalesce("n.visit_count", F.lit(0))).alias("visit_count"),
        F.when(F.col("n.url_hash").isNull(), F.col("s.content_hash")).otherwise(F.col("n.content_hash")).alias("content_hash"), changed.alias("has_changed"),
    )


def configured(config: DataFrame, states: DataFrame) -> DataFrame:
    """The configured sources with the stored enabled state; enabled where none is stored. By
    priority, then name."""
    stored = states.select("name", F.col("enabled").alias("_stored"))
    out = config.join(stored, "name", "left").withColumn("enabled", F.coalesce("_stored", F.lit(True))).drop("_stored")
    return out.orderBy("priority", "name")


def batch_totals(results: DataFrame) -> DataFrame:
    """Sums over the per-document results of a generator batch (status, pairs)."""
    return results.agg(
        F.count("*").alias("processed"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("generated"),
        F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "skipped").alias("skipped"),
    )


def iso(ts: Column) -> Column:
    """A timestamp as ISO-8601 text, with a fraction only if there is one."""
    return F.regexp_replace(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")


def cached_hashes(seen: DataFrame, as_of: Column, seconds: int) -> DataFrame:
    """The hashes (hash, id, ts) still remembered at a time: the latest id of each."""
    live = seen.where(F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")) < F.lit(seconds * 1_000_000))
    return live.groupBy("hash").agg(F.max_by("id", F.struct("ts", "id")).alias("id"))


def pipeline_overview(docs: DataFrame, pairs: DataFrame, as_of: Column, minutes: int = 10) -> DataFrame:
    """One row: unique, pending and eligible documents, pairs, the last scrape, and what came in
    the last ``minutes``; one pass over each table."""
    unique = ~F.col("is_duplicate")
    pending = unique & (F.col("qa_count") == 0)
    eligible = pending & F.col("pipeline_stage").isin("deduplicated", "quality_checked", "stored") & (F.col("word_count") >= 20) & (F.col("content_length") >= 100)
    d = docs.agg(
        F.count_if(unique).alias("unique_documents"), F.count_if(pending).alias("pending_qa"), F.count_if(eligible).alias("qa_eligible"),
        F.max("date_scraped").alias("last_scrape"), F.count_if(recent(F.col("date_scraped"), as_of, minutes)).alias("docs_recently"),
    )
    return d.crossJoin(pairs.agg(F.count("*").alias("total_qa_pairs")))


def recent(ts: Column, as_of: Column, minutes: int) -> Column:
    return ts >= as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def recent_rounds(rounds_: DataFrame, limit: int = 10) -> DataFrame:
    return rounds_.orderBy(F.col("round_number").desc()).limit(bounded(limit, 1, 50))


def with_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Documents with the list of their pairs by date and hash, empty where there are none; a
    document's pairs are few, as a prompt asks for a handful."""
    listed = pairs.groupBy(F.col("document_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct("date_generated", "qa_hash", "question", "answer"))).alias("qa_pairs"))
    out = docs.join(listed, "id", "left")
    return out.withColumn("qa_pairs", F.coalesce("qa_pairs", F.array().cast(listed.schema["qa_pairs"].dataType)))


def with_source_id(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds source_id by source_name; null where the source is unknown."""
    ids = sources.select(F.col("name").alias("source_name"), F.col("id").alias("source_id"))
    return rows.join(ids, "source_name", "left")


def known_word_count(stored: Column, counted: Column) -> Column:
    """The stored number of words, counted anew where it is missing or zero."""
    return F.coalesce(F.nullif(stored, F.lit(0)), counted)


def run_sql(statement: str, views: dict[str, DataFrame], **args: object) -> DataFrame:
    """A SQL statement over named tables; {name} stands for a table and :name for a value."""
    spark = next(iter(views.values())).sparkSession
    return spark.sql(statement, args=args or None, **views)
