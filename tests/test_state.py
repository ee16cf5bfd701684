"""Streams whose state is kept by key, over several micro-batches and restarts."""

from __future__ import annotations

import datetime
import random

from corpusloom.operators import analytics
from corpusloom.streaming import rounds, state
from corpusloom.streaming.snapshots import Change, Snapshots

T0 = datetime.datetime(2024, 1, 1)
VISITS = "event_id long, ts timestamp_ntz, url_hash string, content_hash string"
BEATS = "event_id long, ts timestamp, url string, content string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def land(spark, folder, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def test_visits_in_any_order(spark, tmp_path):
    r = random.Random(2)
    events = [(k, at(k // 2), "uvw"[k % 3] if k % 5 else "x", r.choice("ab") if k % 7 else None) for k in range(60)]
    r.shuffle(events)
    tables = Snapshots(spark, str(tmp_path / "tables"))
    for lot in range(3):
        land(spark, str(tmp_path / "in"), events[20 * lot : 20 * lot + 20], VISITS)
        with state.rocksdb(spark):
            stream = state.visits(rounds.events(spark, str(tmp_path / "in"), VISITS))
            q = stream.writeStream.foreachBatch(lambda b, i: tables.commit("visits", i, lambda: {"v": Change(b, key=["url_hash"])}) and None)
            q.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        so_far = spark.createDataFrame(events[: 20 * lot + 20], VISITS)
        wanted = analytics.visited(so_far)
        assert rows(tables.read("v").select(*wanted.columns)) == rows(wanted)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != state.PROVIDER


def test_ttl_forgets(spark, tmp_path):
    """Two tiers, 1 hour and 24 hours; what is remembered at the end is only what is still live."""
    lots = [
        [(1, at(0), "a", "x"), (2, at(10), "a", "x"), (3, at(20), "b", None)],
        [(4, at(3599), "a", "y"), (5, at(3600), "a", "x"), (6, at(3700), "b", "x")],
        [(7, at(90000), "c", "x"), (8, at(89999), "c", "z")],
        [(9, at(200000), "d", "w"), (10, at(100), "late", "late")],
    ]
    counts = []
    for lot in lots:
        land(spark, str(tmp_path / "in"), lot, BEATS)
        with state.rocksdb(spark):
            rounds.to_table(state.admitted(rounds.events(spark, str(tmp_path / "in"), BEATS)), str(tmp_path / "out"), str(tmp_path / "cp"))
            counts.append(spark.read.format("statestore").option("stateVarName", "until").load(str(tmp_path / "cp")).count())
    got = rows(spark.read.parquet(str(tmp_path / "out")).select("tier", "key", "event_id"))
    assert got == sorted([
        ("url", "a", 1), ("url", "b", 3), ("url", "a", 5), ("url", "b", 6), ("url", "c", 8), ("url", "d", 9),
        ("content", "x", 1), ("content", "y", 4), ("content", "x", 7), ("content", "z", 8), ("content", "w", 9),
    ], key=repr)
    # Ten keys were seen; after the last watermark only d and w are held.
    assert counts[0] == 3 and counts[-1] == 2


def test_keys_of_a_bucket_are_held_together(spark, tmp_path):
    """Many keys make few calls to the state store, and each is still forgotten in its own time."""
    r = random.Random(3)
    events = sorted((r.randrange(20000), r.choice("abcdefgh"), None if r.random() < 0.1 else r.choice("xyz")) for _ in range(400))
    events = [(n, at(s), u, c) for n, (s, u, c) in enumerate(events)]
    tiers, wanted = {"url": 300, "content": 1500}, []
    for column, tier in ((2, "url"), (3, "content")):
        until = {}
        for e in events:
            if e[column] is not None and e[1] >= until.get(e[column], T0):
                until[e[column]] = e[1] + datetime.timedelta(seconds=tiers[tier])
                wanted.append((tier, e[column], e[0]))
    for lot in range(4):
        land(spark, str(tmp_path / "in"), events[100 * lot : 100 * lot + 100], BEATS)
        with state.rocksdb(spark):
            stream = state.admitted(rounds.events(spark, str(tmp_path / "in"), BEATS), tiers, buckets=2)
            rounds.to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("tier", "key", "event_id")) == sorted(wanted, key=repr)
    held = spark.read.format("statestore").option("stateVarName", "until").load(str(tmp_path / "cp"))
    # A key stays while the watermark, 10 minutes behind the batches before, hasn't passed its time.
    newest = {(t, k): e for t, k, e in sorted(wanted, key=lambda w: w[2])}
    live = {k for k, e in newest.items() if events[e][1] + datetime.timedelta(seconds=tiers[k[0]] + 600) > events[-1][1]}
    assert held.count() == len(live) < len(newest)
    assert held.select("key").distinct().count() <= 4


def test_sessions_close_and_drop_late_beats(spark, tmp_path):
    lots = [[(1, at(0), "m", ""), (2, at(100), "m", ""), (3, at(280), "m", ""), (4, at(461), "m", "")], [(5, at(5000), "n", "")], [(6, at(200), "m", ""), (7, at(5100), "n", ""), (8, at(9000), "m", "")]]
    seen = []
    for lot in lots:
        land(spark, str(tmp_path / "in"), lot, BEATS)
        stream = rounds.sessions(rounds.events(spark, str(tmp_path / "in"), BEATS), "url")
        rounds.to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
        seen.append([(r.url, (r.started - T0).total_seconds(), (r.last_beat - T0).total_seconds(), r.beats) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("started").collect()])
    # A gap of 180 seconds is within a run, a longer one isn't; the beat at 200 came too late.
    first = [("m", 0, 280, 3), ("m", 461, 461, 1)]
    assert seen == [[], first, [*first, ("n", 5000, 5100, 2)]]
