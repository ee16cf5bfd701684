"""Lookups that prune, languages, the reply table function, and band joins of hot values."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import language
from corpusloom.operators import dedup, qa
from corpusloom.sources import indexed


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def rows_scanned(df):
    """Rows that the scan of a collected frame handed on, after row groups were left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    (leaf,) = [x for x in (plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size()))]
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_prune_row_groups(spark, tmp_path):
    docs = spark.range(40000).select(F.sha2(F.col("id").cast("string"), 256).alias("url_hash"), F.sha2((F.col("id") % 39990).cast("string"), 224).alias("content_hash"), "id")
    path = str(tmp_path / "indexed")
    indexed.write(docs, path, "url_hash", ("content_hash",), files=4, row_group_bytes=1 << 17, distinct=2000)
    table = indexed.read(spark, path)
    wanted = docs.where("id in (5, 77, 39995)").collect()
    by_url = indexed.lookup(table, "url_hash", [r.url_hash for r in wanted] + ["no such", None])
    assert sorted(r.id for r in by_url.collect()) == [5, 77, 39995]
    assert rows_scanned(by_url) < 40000 / 4
    by_content = indexed.lookup(table, "content_hash", [wanted[0].content_hash])
    assert sorted(r.id for r in by_content.collect()) == [5, 39995]
    assert rows_scanned(by_content) < 40000 / 4
    assert indexed.lookup(table, "url_hash", []).count() == 0
    many = [r.url_hash for r in docs.where("id % 100 = 3").collect()]
    assert len(many) > indexed.LISTED and indexed.lookup(table, "url_hash", many).count() == 400
    assert indexed.lookup(table, "url_hash", docs.where("id < 7")).count() == 7


def test_language_profiles(spark):
    en, de = "the weather is fine and the birds are singing in the tall trees " * 3, "das wetter ist schön und die vögel singen in den hohen bäumen " * 3
    docs = spark.createDataFrame([("en", en), ("de", de), ("de", de + "!?"), (None, "xx yy"), ("fr", None), ("fr", " 12 ")], "lang string, text string")
    found = language.profiles(docs, "lang", "text", 20)
    assert {r.lang for r in found.collect()} == {"en", "de"} and found.where("rank = 1").count() == 2 and found.count() == 40
    want = language.grams(en).most_common()
    best = {g for g, _ in sorted(want, key=lambda x: (-x[1], x[0]))[:20]}
    assert {r.gram for r in found.where("lang = 'en'").collect()} == best
    detector = language.Detector(found)
    texts = spark.createDataFrame([(1, "die bäume und die vögel singen in dem wetter das schön ist"), (2, "trees and birds in the fine weather are singing the tall songs"), (3, "kurz"), (4, None), (5, ""), (6, "1234567890 " * 20), (7, "die vögel " * 100000)], "i int, t string")
    assert {r.i: r.l for r in texts.select("i", detector.detect(F.col("t")).alias("l")).collect()} == {1: "de", 2: "en", 3: "en", 4: "en", 5: "en", 6: "en", 7: "de"}
    assert language.Detector(found.where("false")).of("die vögel singen " * 9) == "en"
    assert language.grams("Ab c")[" a"] == 1 and sum(language.grams("ab").values()) == 4 + 3 + 2 + 1 and not language.grams(" 1 ")


GOOD = "What should be done when the engine of this car makes a knocking noise at idle?"


def test_reply_rows(spark):
    pair = {"question": GOOD, "answer": "Check the oil level and then the bearings."}
    leak = {"question": GOOD + " As the author says.", "answer": pair["answer"]}
    short = {"question": GOOD, "answer": "  yes\t "}
    replies = [(1, json.dumps([pair, leak, pair, short]), "done"), (2, "nothing", "done"), (3, "", "failed"), (4, None, "done"), (5, "```" + json.dumps({"x": [pair]})[:-4] + '"}', "done"), (6, json.dumps(pair), None)]
    df = spark.createDataFrame([(*r, "clash") for r in replies], "id int, reply string, status string, question string")
    got = rows(qa.reply_rows(df).select("id", "status"))
    assert got == sorted([(1, "kept"), (1, "kept"), (1, "unfit"), (1, "unfit"), (2, "empty"), (3, "failed"), (4, "empty"), (5, "kept"), (6, "kept")])
    kept = qa.reply_rows(df).where("status = 'kept'").select("id", "question", "answer")
    assert rows(kept) == rows(qa.pairs_from_replies(df))
    assert rows(qa.outcomes(qa.reply_rows(df))) == sorted([("kept", 3, 4), ("unfit", 1, 2), ("empty", 2, 0), ("failed", 1, 0)])


@pytest.mark.parametrize("block", [7, 4096])
def test_hot_band(spark, block):
    """A third of the rows share one band value; marks are those of the plain definition."""
    r = random.Random(9)
    mask = (1 << 63) - 1
    prints = []
    for i in range(300):
        hi = (0x12345678 << 32 | r.getrandbits(6) << 3) if i % 3 == 0 else r.getrandbits(63)
        lo = r.choice([0, 1, 7, 0xFF, r.getrandbits(63)]) if i % 3 == 0 else r.getrandbits(63)
        prints.append((i, r.randrange(50), hi & mask, lo & mask))
    near = lambda a, b: (a[2] ^ b[2]).bit_count() + (a[3] ^ b[3]).bit_count()
    words = lambda p: [p[2] >> 32, p[2] & 0xFFFFFFFF, p[3] >> 32, p[3] & 0xFFFFFFFF]
    def meet(a, b):
        return near(a, b) <= 19 and any(x == y for x, y in zip(words(a), words(b), strict=True))

    df = spark.createDataFrame(prints, "id long, created_at long, hi long, lo long")
    want = {}
    for a in prints:
        older = [(b[1], b[0], near(a, b)) for b in prints if (b[1], b[0]) < (a[1], a[0]) and meet(a, b)]
        if older:
            want[a[0]] = min(older)[1:]
    got = {r.id: (r.older_id, r.distance) for r in dedup.oldest_similar(df, block=block).collect()}
    assert got == want and len(want) > 60
    new, known = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    got = {r.id: r.older_id for r in dedup.oldest_similar(new, known, among=False, block=block).collect()}
    assert got == {a[0]: min((b[1], b[0]) for b in prints if b[0] % 2 and meet(a, b))[1] for a in prints if a[0] % 2 == 0 and any(b[0] % 2 and meet(a, b) for b in prints)}
    pairs = {(r.id, r.older_id) for r in dedup.near_pairs(df.select("id", "hi", "lo"), block=block).collect()}
    lead = {}
    for p in prints:
        lead.setdefault(p[2:], p)
    assert pairs == {(a[0], b[0]) for a in lead.values() for b in lead.values() if a[0] > b[0] and meet(a, b)}
