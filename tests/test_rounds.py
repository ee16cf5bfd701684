"""Rounds over landed folders: versions committed whole, replays, changes, duplicates, pairs."""

from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.python import fingerprint
from corpusloom.operators import changes
from corpusloom.storage import stored
from corpusloom.streaming import corpus as corpus_module
from corpusloom.streaming.corpus import ITEMS, PAIRS, Corpus, until_settled
from corpusloom.streaming.snapshots import Change, Snapshots

WORDS = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree by the river bank and count every leaf".split()


def prose(n):
    return " ".join(WORDS[(i * n + i // 3) % len(WORDS)] + (str(n) if i % 4 == 0 else "") for i in range(60))


def alike(a, b):
    """Whether two texts share a band of their fingerprints and are near enough."""
    x, y = (b"".join(v.to_bytes(8, "big", signed=True) for v in fingerprint(t)) for t in (a, b))
    distance = sum((p ^ q).bit_count() for p, q in zip(x, y, strict=True))
    return distance <= 19 and any(x[i : i + 4] == y[i : i + 4] for i in range(0, 16, 4))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def url(u):
    return f"https://site.example/{u}"


def hashed(spark, u):
    return spark.range(1).select(T.url_hash(F.lit(url(u)))).first()[0]


def land(spark, folder, items, at=0):
    data = [("s", url(u), text, "en", datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=at + i)) for i, (u, text) in enumerate(items)]
    spark.createDataFrame(data, ITEMS).coalesce(1).write.mode("append").parquet(folder)


def land_pairs(spark, folder, keys, per=3):
    q = "What should be done when the engine of this car makes a knocking noise at idle, case {} of {}?"
    data = [(k, q.format(i, k), "Check the oil level and then the bearings of the engine.", "m", datetime.datetime(2024, 2, 1)) for k in keys for i in range(per)]
    spark.createDataFrame(data, PAIRS).coalesce(1).write.mode("append").parquet(folder)


def test_snapshots(spark, tmp_path):
    s = Snapshots(spark, str(tmp_path / "t"))
    frame = lambda data: spark.createDataFrame(data, "id long, v string")
    assert s.read("a") is None and s.manifest().version == 0
    assert s.commit("x", 0, lambda: {"a": Change(frame([(1, "a"), (2, "b")]), key=["id"]), "log": Change(frame([(0, "first")]))})
    assert s.commit("x", 1, lambda: {"a": Change(frame([(2, "c"), (3, "d")]), frame([(1, ""), (3, "")])), "log": Change(frame([(1, "next")]))})
    assert rows(s.read("a")) == [(2, "c"), (3, "d")]  # a key both put and deleted is put
    assert rows(s.read("log")) == [(0, "first"), (1, "next")]
    assert rows(s.read("a", 1)) == [(1, "a"), (2, "b")]
    # A batch that is in already, or an older one, changes nothing and isn't even planned.
    assert not s.commit("x", 1, lambda: 1 / 0) and not s.commit("x", 0, lambda: 1 / 0)
    for i in range(2, 14):
        assert s.commit("x", i, lambda i=i: {"a": Change(frame([(i, "n")]))})
    assert rows(s.read("a")) == rows(frame([(2, "n"), (3, "n"), *((i, "n") for i in range(4, 14))]))
    assert len(s.manifest().tables["a"].parts) <= 8
    before = rows(s.read("a"))
    s.expire(1)
    assert rows(s.read("a")) == before and rows(s.read("log")) == [(0, "first"), (1, "next")]
    assert Snapshots(spark, str(tmp_path / "t")).manifest().applied == {"x": 13}


def test_plan_of_a_batch(spark):
    def items(data):
        df = spark.createDataFrame([("s", f"u{u}", t, datetime.datetime(2024, 1, 1, 0, m)) for u, t, m in data], "source_name string, url_hash string, content_text string, date_scraped timestamp_ntz")
        return df.withColumns({"content_hash": T.content_hash(F.col("content_text")), "content_length": F.length("content_text"), "word_count": F.lit(60)})

    none = spark.createDataFrame([], changes.DOCUMENTS)
    similar = next(t for t in (f"{prose(1)} {w}" for w in WORDS) if alike(t, prose(1)))
    first = changes.plan_batch(items([(1, prose(1), 1), (2, prose(1), 2), (3, prose(2), 3), (4, similar, 4), (5, prose(5), 5), (5, prose(7), 6)]), none, 1)
    got = {r.id: r for r in first.documents.collect()}
    assert {k: r.method.split("(")[0] for k, r in got.items()} == {"u1": "unique", "u2": "exact_hash", "u3": "unique", "u4": "simhash", "u5": "unique"}
    assert got["u2"].duplicate_of == got["u4"].duplicate_of == "u1" and got["u2"].content_text is None and got["u4"].hi is None
    assert got["u5"].content_text == prose(7)  # the last of one address
    assert first.changed.count() == 0
    # The first text of u1 is gone after its change, so the same text at a new address is no copy.
    later = changes.plan_batch(items([(1, prose(9), 11), (3, prose(2), 12), (2, prose(3), 13), (6, prose(1), 14), (7, prose(9), 15), (8, prose(2), 16)]), first.documents, 2)
    got = {r.id: r for r in later.documents.collect()}
    assert {k: r.method.split("(")[0] for k, r in got.items()} == {"u1": "changed", "u6": "unique", "u7": "exact_hash", "u8": "exact_hash"}
    assert (got["u7"].duplicate_of, got["u8"].duplicate_of, got["u1"].created_at.minute, got["u1"].pipeline_stage) == ("u1", "u3", 1, "stored")
    assert [r[0] for r in later.changed.collect()] == ["u1"]
    assert sorted(r.outcome for r in later.outcomes.collect()) == ["changed", "duplicate", "duplicate", "stored", "unchanged", "url_hash"]


def test_texts_stay_where_they_landed(spark, tmp_path, monkeypatch):
    """Of a batch only the items are stored with texts, those of admitted ones, and exact copies get no fingerprint."""
    wide, printed = {}, []

    def keep(df, name, *by):
        out = stored(df, name, *by)
        if "content_text" in out.columns:
            wide[name] = out
        return out

    def prints(docs, shortest=50):
        printed.append(docs.count())
        return fingerprints(docs, shortest)

    for module in (changes, corpus_module, changes.dedup):
        monkeypatch.setattr(module, "stored", keep)
    fingerprints = changes.dedup.fingerprints
    monkeypatch.setattr(changes.dedup, "fingerprints", prints)
    items = str(tmp_path / "items")
    land(spark, items, [(1, prose(1)), (2, prose(1)), (3, prose(2)), (4, "too short"), (3, prose(5))])
    c = Corpus(spark, str(tmp_path / "c"))
    c.ingest(spark.read.schema(ITEMS).parquet(items), 0, 1)
    assert list(wide) == ["items"] and sorted(r[0] or "" for r in wide["items"].select("content_text").collect()) == sorted(["", prose(1), prose(1), prose(2), prose(5)])
    assert printed == [2]
    docs = {r.id: (r.content_text, r.duplicate_of) for r in c.table("documents").collect()}
    key = {u: hashed(spark, u) for u in (1, 2, 3)}
    assert docs == {key[1]: (prose(1), None), key[2]: (None, key[1]), key[3]: (prose(5), None)}
    some = c.table("documents", spark.createDataFrame([(key[2],), ("none",)], "id string"))
    assert [r.id for r in some.collect()] == [key[2]]


def test_rounds(spark, tmp_path):
    c = Corpus(spark, str(tmp_path / "c"), min_pairs=3)
    items, pairs = str(tmp_path / "items"), str(tmp_path / "pairs")
    key = {u: hashed(spark, u) for u in range(8)}
    land(spark, items, [(1, prose(1)), (2, prose(2)), (3, prose(1)), (4, "too short")])
    land_pairs(spark, pairs, [key[1]])  # nothing was pending before the round
    assert c.run_round(1, items, pairs) == "completed"
    assert c.table("qa_pairs").count() == 0 and c.pending() == 2
    # Round 2: pairs for both; one of them changes in the same round, one new address comes.
    land(spark, items, [(2, prose(5)), (5, prose(6)), (1, prose(1))], 100)
    land_pairs(spark, pairs, [key[1], key[2], key[3], "unknown"])
    c.run_round(2, items, pairs)
    docs = {r.id: r for r in c.table("documents").collect()}
    assert (docs[key[1]].qa_count, docs[key[1]].pipeline_stage) == (3, "qa_generated")
    assert (docs[key[2]].qa_count, docs[key[2]].pipeline_stage, docs[key[2]].content_text) == (0, "stored", prose(5))
    assert {r.document_id for r in c.table("qa_pairs").collect()} == {key[1]}
    # Round 3: a document with pairs changes, its pairs go; too few pairs skip a document for good.
    land(spark, items, [(1, prose(7))], 200)
    land_pairs(spark, pairs, [key[2]], per=2)
    land_pairs(spark, pairs, [key[5]])
    c.run_round(3, items, pairs)
    docs = {r.id: r for r in c.table("documents").collect()}
    assert {u: (docs[key[u]].qa_count, docs[key[u]].pipeline_stage) for u in (1, 2, 5)} == {1: (0, "stored"), 2: (0, "qa_skipped"), 5: (3, "qa_generated")}
    assert {r.document_id for r in c.table("qa_pairs").collect()} == {key[5]}
    log = {r.round_number: r for r in c.table("rounds").collect()}
    assert [tuple(r for k, r in log[n].asDict().items() if k != "began")[1:8] for n in (1, 2, 3)] == [("completed", 4, 2, 1, 0, 0, 1), ("completed", 3, 1, 0, 1, 1, 0), ("completed", 1, 0, 0, 1, 0, 0)]
    total = c.table("documents").count()
    assert total == c.table("documents").where("not is_duplicate").count() + c.table("documents").where("is_duplicate").count() == 4
    # Nothing has landed: a round changes nothing.
    before = rows(c.table("documents"))
    c.run_round(4, items, pairs)
    assert rows(c.table("documents")) == before


def test_replay_after_a_crash(spark, tmp_path, monkeypatch):
    """A run that dies while it commits, and one that dies right after, end in the same tables."""
    def run(name, *failures):
        c = Corpus(spark, str(tmp_path / name), min_pairs=1)
        items, pairs = str(tmp_path / f"{name}-items"), str(tmp_path / f"{name}-pairs")
        land_pairs(spark, pairs, [])
        number = 0
        for texts in ([(1, prose(1)), (2, prose(2)), (3, prose(1))], [(1, prose(4)), (4, prose(2)), (5, prose(5))]):
            number += 1
            land(spark, items, texts, 50 * number)
            if number == 2:
                land_pairs(spark, pairs, [hashed(spark, 2), hashed(spark, 1)])
            for failure in failures:
                with monkeypatch.context() as m:
                    failure(m)
                    with pytest.raises(Exception, match="died"):
                        c.run_round(number, items, pairs)
                assert {r.round_number: r.status for r in c.table("rounds").collect()}[number] == "failed"
            c.run_round(number, items, pairs)
        docs = c.table("documents")
        return rows(docs), rows(c.table("qa_pairs")), rows(c.table("rounds").drop("began"))

    def before_manifest(m):
        write = corpus_module.Snapshots._written

        def dies(self, table, change, old):
            out = write(self, table, change, old)
            if table == "qa_pairs":
                raise RuntimeError("died between the writes")
            return out

        m.setattr(corpus_module.Snapshots, "_written", dies)

    def after_manifest(m):
        ingest = Corpus.ingest

        def dies(self, *args):
            ingest(self, *args)
            raise RuntimeError("died after the commit")

        m.setattr(Corpus, "ingest", dies)

    wanted = run("calm")
    assert len(wanted[0]) == 5 and len(wanted[1]) == 3
    assert run("torn", before_manifest) == wanted
    assert run("late", after_manifest) == wanted


def test_answers_until_nothing_waits(spark, tmp_path):
    """Batches of the queue: documents with pairs, with too few, and with failing calls."""
    c = Corpus(spark, str(tmp_path / "c"), min_pairs=2)
    items = str(tmp_path / "items")
    land(spark, items, [(u, f"mark{u} {prose(u + 1)}") for u in range(6)] + [(9, "short")])
    c.ingest(spark.read.schema(ITEMS).parquet(items), 0, 1)
    waiting = c.pending()
    assert waiting == c.table("documents").where("not is_duplicate").count() >= 5
    good = "What should be done when the engine of this car makes a knocking noise at idle, case {} of {}?"

    def generator(prompt):
        mark = prompt.split()[0]
        if mark == "mark1" and fails:
            raise RuntimeError("no model")
        return json.dumps([{"question": good.format(i, mark), "answer": "Check the oil level and then the bearings."} for i in range(1 if mark == "mark2" else 3)])

    fails = True
    made = c.answer_all(generator, 2)
    stages = {r.content_text.split()[0]: (r.pipeline_stage, r.qa_count) for r in c.table("documents").where("not is_duplicate").collect()}
    assert stages["mark2"] == ("qa_skipped", 0) and stages["mark1"] == ("deduplicated", 0) and c.pending() == 1
    assert made == c.table("qa_pairs").count() == 3 * (waiting - 2) == sum(n for _, n in stages.values())
    assert c.answer_all(generator, 5) == 0 and c.pending() == 1  # a batch without pairs ends it
    fails = False
    assert c.answer_all(generator, 5) == 3 and c.pending() == 0 and c.answer_all(generator, 5) == 0


def test_until_settled():
    left = [5]

    def step():
        left[0] -= 2
        return 2

    assert until_settled(step, lambda: max(0, left[0])) == 6
    assert until_settled(lambda: 0, lambda: 3) == 0


def test_parts_are_read_with_one_join(spark, tmp_path):
    """However many parts a table has, its old rows meet the newer keys in one join; what came after a version is told by its parts."""
    s = Snapshots(spark, str(tmp_path / "t"))
    frame = lambda data: spark.createDataFrame(data, "k string, n long, v string")
    wanted = {}
    for i in range(6):
        data = [("a", n, f"{i}-{n}") for n in range(i, 8, i + 1)] + [(None, i, "null")]
        gone = [("a", n, "") for n in range(7) if n % 5 == i]
        assert s.commit("x", i, lambda data=data, gone=gone: {"t": Change(frame(data), frame(gone), ["k", "n"])})
        keys = {r[:2] for r in data}
        wanted = {k: v for k, v in wanted.items() if k not in {g[:2] for g in gone} - keys} | {r[:2]: r for r in data}
    assert rows(s.read("t")) == sorted(wanted.values(), key=repr)
    some = spark.createDataFrame([("a", 5), ("a", 2), ("b", 1)], "k string, n long")
    assert rows(s.read("t", only=some)) == sorted((r for k, r in wanted.items() if k in (("a", 5), ("a", 2))), key=repr)
    plan = s.read("t")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert s.since("none", 0) is None and s.since("t", 6).count() == 0
    assert rows(s.since("t", 0)) == rows(s.read("t"))
    assert rows(s.since("t", 5)) == rows(s.read("t").where("v like '5-%' or n = 5 and k is null"))
    for i in range(6, 9):
        s.commit("x", i, lambda i=i: {"t": Change(frame([("c", i, "new")]))})
    assert len(s.manifest().tables["t"].parts) == 1 and rows(s.since("t", 7)) == rows(s.read("t"))  # written whole since


def test_known_documents_are_put_together_once(spark, monkeypatch):
    """A batch reads the parts of the stored documents in one step, without their texts."""
    read = []

    def keep(df, name, *by):
        read.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("known_rows")))
        return stored(df, name, *by)

    monkeypatch.setattr(changes, "stored", keep)
    one = spark.createDataFrame([("s", "u1", prose(1), datetime.datetime(2024, 1, 1))], "source_name string, url_hash string, content_text string, date_scraped timestamp_ntz")
    one = one.withColumns({"content_hash": T.content_hash(F.col("content_text")), "content_length": F.length("content_text"), "word_count": F.lit(60)})
    none = spark.createDataFrame([], changes.DOCUMENTS)
    known = none.withColumn("id", F.concat(F.lit("known_rows"), F.spark_partition_id().cast("string")))
    made = changes.plan_batch(one, known, 1)
    assert {n: k for n, k in read if k} == {"known": 1} and made.documents.count() == 1
