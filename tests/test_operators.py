from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import analytics, dedup, gates, qa, upsert
from corpusloom.sources import landing, sinks
from corpusloom.streaming import rounds


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def texts(spark, items):
    df = spark.createDataFrame(items, "id long, content_text string")
    return df.withColumn("content_hash", F.sha2("content_text", 256))


LONG = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree by the river bank " * 2


def test_exact(spark):
    docs = texts(spark, [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)])
    out = dedup.exact(docs)
    assert rows(out.select("id", "is_duplicate", "duplicate_of")) == [(1, False, None), (2, False, None), (3, True, 1), (4, False, None), (5, False, None)]
    assert out.count() == docs.count()
    again = dedup.exact(out.where(~F.col("is_duplicate")).select("id", "content_text", "content_hash"))
    assert again.where("is_duplicate").count() == 0


def test_near(spark):
    docs = texts(spark, [(1, LONG), (2, LONG + " end"), (3, LONG), (4, "something else entirely that has nothing in common with the rest of these texts")])
    marks = {r.id: r.duplicate_of for r in dedup.near_marks(docs).collect()}
    assert marks[3] == 1 and marks.get(2, 1) == 1 and 4 not in marks and 1 not in marks
    assert all(older < newer for newer, older in marks.items())


def test_roots(spark):
    marks = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (9, 8)], "id long, duplicate_of long")
    assert rows(dedup.roots(marks)) == [(2, 1), (3, 1), (4, 1), (9, 8)]


def test_classify(spark):
    docs = texts(spark, [(1, LONG), (2, "other " * 30)]).withColumn("url_hash", F.sha2(F.col("id").cast("string"), 256)).withColumn("is_duplicate", F.lit(False))
    known = docs.join(dedup.fingerprints(docs), "id", "left")
    new = texts(spark, [(10, LONG), (11, "fresh words that nobody has written down before in this little corpus of ours"), (2, "changed at the same address")]).withColumn("url_hash", F.sha2(F.col("id").cast("string"), 256))
    got = {r.id: (r.method, r.duplicate_of) for r in dedup.classify(new, known).collect()}
    assert got == {10: ("exact_hash", 1), 11: ("unique", None), 2: ("url_hash", 2)}


def test_minhash(spark):
    docs = texts(spark, [(1, LONG), (2, LONG + "!"), (3, "zq " * 40)])
    assert [(r.id, r.older_id) for r in dedup.minhash_pairs(docs).collect()] == [(2, 1)]


def test_gates(spark):
    df = spark.createDataFrame([(1, "x" * 100, "word " * 20), (2, "x" * 99, "word " * 40)], "id long, a string, b string")
    assert [r.id for r in df.where(gates.long_enough(F.length("a"), F.lit(20))).collect()] == [1]
    reasons = spark.createDataFrame([("t" * 200, "bad", 0.9), ("t", "s", 0.9), ("t" * 200, "s", 0.5), ("t" * 200, "s", 0.6)], "t string, s string, q double")
    got = [r[0] for r in reasons.select(gates.skip_reason(F.col("t"), F.col("s"), F.col("q"), ("bad",))).collect()]
    assert got == ["source_skipped", "text_too_short", "low_quality", None]


def test_generate_and_filter(spark):
    docs = spark.createDataFrame([(1, "text one"), (2, "fail")], "id long, content_text string")
    question, answer = "What is the right tyre pressure for a compact car in cold weather months?", "Around 35 psi, checked when cold."

    def stub(prompt):
        if prompt == "fail":
            raise RuntimeError("no answer")
        return json.dumps([{"question": question, "answer": answer}] * 2 + [{"question": "short?", "answer": answer}])

    pairs = qa.pairs_from_replies(qa.generate(docs, stub))
    assert rows(pairs) == [(1, question, answer)] * 2
    assert qa.at_least(pairs, 3).count() == 0 and qa.at_least(pairs, 2).count() == 2
    assert qa.annotate(pairs).select("qa_hash").distinct().count() == 1


def test_export(spark, tmp_path):
    pairs = spark.createDataFrame([("q2", "a2", "s", "", "", "", 0.5, "m", "h2", datetime.datetime(2024, 1, 2)), ("q1é", "a1", None, "", "", "", None, "m", "h1", datetime.datetime(2024, 1, 1))],
        "question string, answer string, source_name string, brand string, model string, year string, quality_score double, llm_model string, qa_hash string, date_generated timestamp")
    sinks.export(pairs, str(tmp_path / "l"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "l")).collect()]
    assert {x["question"] for x in lines} == {"q1é", "q2"} and lines[0].keys() >= {"source", "quality_score", "llm_model"}
    sinks.export(pairs, str(tmp_path / "j"), "json", chat=True)
    (array,) = spark.read.text(str(tmp_path / "j")).collect()
    assert [m["messages"][0]["content"] for m in json.loads(array.value)] == ["q1é", "q2"]


def test_upserts(spark):
    old = spark.createDataFrame([("a", True, 1), ("b", False, 2)], "name string, enabled boolean, priority int")
    new = spark.createDataFrame([("b", True, 9), ("c", True, None)], "name string, enabled boolean, priority int")
    assert rows(upsert.upsert(old, new, "name", ("enabled",))) == [("a", True, 1), ("b", False, 9), ("c", True, None)]
    fresh = spark.createDataFrame([("c", False, 3), ("c", True, 3), ("a", True, 7)], "name string, enabled boolean, priority int")
    assert rows(upsert.insert_if_absent(fresh, old, "name", ["priority", "enabled"])) == [("c", False, 3)]
    merged = spark.createDataFrame([('{"a":"1"}',), (None,)], "m string").select(upsert.merge_metadata(F.col("m"), "k", F.lit("v")))
    assert [json.loads(r[0]) for r in merged.collect()] == [{"a": "1", "k": "v"}, {"k": "v"}]


def test_visits(spark):
    t = datetime.datetime
    visits = spark.createDataFrame([(1, t(2024, 1, 1), "u", "x"), (2, t(2024, 1, 2), "u", "y"), (3, t(2024, 1, 3), "w", "x"), (4, t(2024, 1, 4), "w", "x")], "event_id long, ts timestamp, url_hash string, content_hash string")
    got = {r.url_hash: (r.visit_count, r.content_hash, r.has_changed) for r in analytics.visited(visits).collect()}
    assert got == {"u": (2, "y", True), "w": (2, "x", False)}


def test_threads_and_forum(spark):
    posts = spark.createDataFrame([("t", 2, 1, "second page post, long enough"), ("t", 1, 1, "first page post, long enough"), ("t", 1, 2, "short"), ("z", 1, 1, "only this one here")], "thread_url string, page int, position int, text string")
    (thread,) = landing.threads(posts).collect()
    assert thread.content_text.startswith("first page") and thread.total_posts == 2 and landing.POST_SEPARATOR in thread.content_text
    payload = json.dumps([{"data": {"children": []}}, {"data": {"children": [{"kind": "t1", "data": {"author": "", "body": "hi", "score": 3}}, {"kind": "more", "data": {}}]}}])
    df = spark.createDataFrame([("1", "/p", "T", "self", None, 0.0, payload)], "id string, permalink string, title string, selftext string, author string, created_utc double, payload string")
    (doc,) = landing.forum_documents(df.withColumn("comments", landing.comments(F.col("payload")))).collect()
    assert doc.content_text == "self [[deleted] | score 3] hi" and doc.author == "[deleted]" and doc.comments_loaded == 1


def test_vehicle_records(spark):
    vehicles = spark.createDataFrame([("Kia", "Soul", 2015)], "make string, model string, year int")
    assert landing.vehicle_requests(vehicles).count() == 3
    payload = spark.createDataFrame([("Kia", "Soul", 2015, "complaints", [{"components": "ENGINE", "summary": "stalls"}]), ("Kia", "Soul", 2015, "recalls", [])], "make string, model string, year int, kind string, records array<map<string,string>>")
    (doc,) = landing.vehicle_documents(payload).collect()
    assert doc.content_text == "Components: ENGINE Summary: stalls" and doc.record_count == 1


def test_stream_rounds(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    land = str(tmp_path / "land")
    spark.createDataFrame([(1, datetime.datetime(2024, 1, 1, 1), 1, "view", 1.0, "")], schema).write.parquet(land)
    seen = []
    stream = lambda: rounds.events(spark, land, schema)
    commit = lambda batch, _: seen.append(batch.count())
    rounds.run_round(stream(), commit, str(tmp_path / "cp"))
    spark.createDataFrame([(2, datetime.datetime(2024, 1, 1, 2), 1, "view", 1.0, "")] * 2, schema).write.mode("append").parquet(land)
    rounds.run_round(stream(), commit, str(tmp_path / "cp"))
    assert seen == [1, 2]
    rounds.to_table(rounds.first_seen(stream(), ["event_id"]), str(tmp_path / "out"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_fold_visits(spark):
    t = datetime.datetime
    events = [(k, t(2024, 1, 1, 0, k), "uvw"[k % 3] if k < 9 else "x", "ab"[(k * k // 5) % 2]) for k in range(12)]
    schema = "event_id long, ts timestamp, url_hash string, content_hash string"
    frame = lambda part: spark.createDataFrame(part, schema)
    wanted = rows(analytics.visited(frame(events)))
    for cut in (3, 6, 9):
        state = analytics.visited(frame(events[:cut]))
        columns = state.columns
        assert rows(analytics.fold_visits(state, frame(events[cut:])).select(*columns)) == wanted


def test_small_rollups(spark):
    config = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "name string, priority int")
    states = spark.createDataFrame([("a", False)], "name string, enabled boolean")
    assert [(r.name, r.enabled) for r in analytics.configured(config, states).collect()] == [("c", True), ("a", False), ("b", True)]
    done = spark.createDataFrame([("generated", 4), ("failed", 0), ("skipped", 0)], "status string, pairs int")
    assert tuple(analytics.batch_totals(done).first()) == (3, 4, 1, 1)
    ts = spark.createDataFrame([(datetime.datetime(2024, 1, 2, 3, 4, 5),), (datetime.datetime(2024, 1, 2, 3, 4, 5, 60),)], "ts timestamp")
    assert [r[0] for r in ts.select(analytics.iso(F.col("ts"))).collect()] == ["2024-01-02T03:04:05", "2024-01-02T03:04:05.000060"]
    seen = spark.createDataFrame([("h", 1, datetime.datetime(2024, 1, 1)), ("h", 2, datetime.datetime(2024, 1, 2)), ("g", 3, datetime.datetime(2023, 1, 1))], "hash string, id int, ts timestamp")
    assert rows(analytics.cached_hashes(seen, F.lit("2024-01-02 10:00:00").cast("timestamp"), 86400)) == [("h", 2)]


def test_long_chains_and_rings(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(300)], "id long, duplicate_of long")
    assert {r.root for r in dedup.roots(chain).collect()} == {0}
    ring = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "id long, duplicate_of long")
    with pytest.raises(ValueError, match="ring"):
        dedup.roots(ring, 4)


def test_metadata_keeps_types(spark):
    texts = [(1, '{"a": 1, "b": [true, null], "c": {"d": 1.5}, "k": 2}'), (2, "not json"), (3, None), (4, "[1]"), (5, "{}")]
    got = spark.createDataFrame(texts, "id int, m string").select("id", upsert.merge_metadata(F.col("m"), "k", F.lit("v")).alias("m"))
    got = {r.id: json.loads(r.m) for r in got.collect()}
    assert got == {1: {"a": 1, "b": [True, None], "c": {"d": 1.5}, "k": "v"}} | {i: {"k": "v"} for i in (2, 3, 4, 5)}


def test_failed_calls_are_counted(spark):
    def call(prompt):
        if "bad" in prompt:
            raise RuntimeError("no model")
        pair = {"question": "What should be done when the engine of this car makes a knocking noise at idle?", "answer": "Check the oil level and then the bearings."}
        return json.dumps([pair] * (3 if "three" in prompt else 1))

    docs = spark.createDataFrame([(1, "three"), (2, "one"), (3, "bad")], "id long, content_text string")
    for concurrency in (None, 1):
        out = qa.results(qa.generate(docs, call, concurrency))
        assert rows(out) == [(1, "generated", 3), (2, "skipped", 0), (3, "failed", 0)]
    assert tuple(analytics.batch_totals(out).first()) == (3, 3, 1, 1)


def test_wrapped_page_is_escaped(spark):
    text = F.lit('a < b & "c"')
    page = spark.range(1).select(sinks.wrapped_html(text, text, text, text, text, F.lit(datetime.datetime(2024, 1, 1)), F.lit(None).cast("timestamp"), F.lit("<b>kept</b>"), text)).first()[0]
    assert "<b>kept</b>" in page and "<h1>a &lt; b &amp; &quot;c&quot;</h1>" in page and 'a < b' not in page


def test_fingerprints_are_computed_once(spark):
    """They are stored before the bands are met: no plan that meets them computes them again."""
    rows = [(i, f"{'words of a text that two rows share ' * 3}{i // 2} and so on") for i in range(8)]
    docs = spark.createDataFrame(rows, "id long, content_text string").withColumns({"content_hash": F.sha2("content_text", 256), "url_hash": F.sha2(F.col("id").cast("string"), 256), "is_duplicate": F.lit(False)})
    even, odd = docs.where("id % 2 = 0"), docs.where("id % 2 = 1")
    found = dedup.classify(odd.drop("is_duplicate"), even.join(dedup.fingerprints(even), "id", "left"))
    assert {(r.id, r.method, r.duplicate_of) for r in found.collect()} == {(i, "exact_hash", i - 1) for i in (1, 3, 5, 7)}
    for out in (found, dedup.near_pairs(dedup.fingerprints(docs))):
        assert "EvalPython" not in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("build", ["html_extract", "forum_documents", "near_dup_pairs", "selector_fields", "vehicle_records"])
def test_batches_of_texts_are_bounded(spark, build):
    from corpusloom.plans import catalog

    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    catalog.QUERIES[build](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 256
