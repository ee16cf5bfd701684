"""State kept by key across micro-batches: visits of an address, and hashes remembered for a time.

Both run on RocksDB state, so that what is held is bounded by disk and only changed keys are
written; a batch touches the keys that it holds and no others. ``rocksdb`` puts the provider in
place for the streams started under it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Seconds for which addresses and contents are remembered.
TIERS = {"url": 3600, "content": 86400}
#: Groups of remembered keys in each tier.
BUCKETS = 4096


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """RocksDB as the state store of streams that start meanwhile."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class _Visits(StatefulProcessor):
    """The first visit, the last two and the number of visits of an address. Visits may come in any
    order: what is kept doesn't depend on it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("visits", "first long, n long, ts long, id long, hash string, ts0 long, id0 long, hash0 string")

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        first, n, last, before = None, 0, None, None
        if self._state.exists():
            s = self._state.get()
            first, n, last = s[0], s[1], (s[2], s[3], s[4])
            before = None if s[5] is None else (s[5], s[6], s[7])
        for r in rows:
            visit = (r.ts, r.event_id, r.content_hash)
            first, n = r.ts if first is None else min(first, r.ts), n + 1
            if last is None or visit[:2] > last[:2]:
                last, before = visit, last
            elif before is None or visit[:2] > before[:2]:
                before = visit
        self._state.update((first, n, *last, *(before or (None, None, None))))
        yield Row(url_hash=key[0], first=first, last=last[0], visit_count=n, content_hash=last[2], has_changed=before is not None and before[2] != last[2])

    def close(self) -> None:
        pass


def visits(stream: DataFrame) -> DataFrame:
    """The state of each address that a batch touches, as ``analytics.visited`` has it over all
    visits so far (event_id, ts, url_hash, content_hash). For output mode ``update``."""
    narrow = stream.select("url_hash", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), F.col("event_id").cast("long").alias("event_id"), "content_hash")
    out = narrow.groupBy("url_hash").transformWithState(
        _Visits(), "url_hash string, first long, last long, visit_count long, content_hash string, has_changed boolean", "Update", "None"
    )
    at = {n: F.timestamp_micros(c).cast("timestamp_ntz").alias(n) for n, c in (("first_visited", "first"), ("last_visited", "last"))}
    return out.select("url_hash", at["first_visited"], at["last_visited"], "visit_count", "content_hash", "has_changed")


class _Remembered(StatefulProcessor):
    """Admits a key's row if the key isn't remembered, and then remembers it for its time.

    The keys of one bucket are read, written and timed together, as each call to the state store
    costs far more than a key: the bucket's timer is that of the key to be forgotten first.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._until = handle.getListState("until", "key string, us long, times long")

    def handleInputRows(self, key: tuple, rows: Iterable[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        held = {k: (until, times) for k, until, times in self._until.get()}
        old, changed = held.copy(), False
        arrived: dict[str, list[tuple]] = {}
        for r in rows:
            arrived.setdefault(r.key, []).append((r.us, r.event_id, r.ttl))
        for k, mine in arrived.items():
            until, times = held.get(k, (None, 0))
            for ts, event_id, ttl in sorted(mine):
                if until is None or ts >= until:
                    until, times, changed = ts + 1_000_000 * ttl, times + 1, True
                    yield Row(tier=key[0], key=k, event_id=event_id, us=ts, times=times)
            held[k] = (until, times)
        if changed:
            self._keep(held)
            before, first = _first_timer(old), _first_timer(held)
            if before != first:
                if before is not None:
                    self._handle.deleteTimer(before)
                self._handle.registerTimer(first)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        passed = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        held = {k: (until, times) for k, until, times in self._until.get() if _timer(until) > passed}
        self._keep(held)
        if held:
            self._handle.registerTimer(_first_timer(held))
        return iter(())

    def _keep(self, held: dict[str, tuple[int, int]]) -> None:
        if held:
            self._until.put([(k, until, times) for k, (until, times) in held.items()])
        else:
            self._until.clear()

    def close(self) -> None:
        pass


def _first_timer(held: dict[str, tuple[int, int]]) -> int | None:
    return min((_timer(until) for until, _ in held.values()), default=None)


def _timer(us: int) -> int:
    """The millisecond after which a key is surely forgotten."""
    return us // 1000 + 1


def admitted(stream: DataFrame, tiers: dict[str, int] | None = None, late: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """tier, key, event_id, ts and ``times`` of each row that is let through: the first of its key,
    and later ones that come when the key has been forgotten, ``ttl`` after it was last let through.
    ``times`` counts within the state's life; a key whose time is up when the watermark passes it
    starts at 1 again.

    ``stream`` has event_id, ts (timestamp), and a column for each tier with the tier's key; rows
    with a null key don't take part in that tier. Rows more than ``late`` behind the newest row of
    the batches before are dropped. The rows of one bucket of keys in one batch are put in order in
    memory, so a batch (``files_per_trigger``) bounds them. A batch writes the buckets that it
    touches; how many there are of each tier, ``buckets``, must stay the same for a checkpoint.
    """
    tiers = TIERS if tiers is None else tiers
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("tier"), F.col(t).cast("string").alias("key"), F.lit(s).cast("long").alias("ttl")) for t, s in tiers.items())))
    rows = stream.withWatermark("ts", late).select("ts", F.col("event_id").cast("long").alias("event_id"), each.alias("t"))
    rows = rows.select("ts", F.unix_micros("ts").alias("us"), "event_id", "t.*").where("key is not null")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    out = rows.groupBy("tier", "bucket").transformWithState(_Remembered(), "tier string, key string, event_id long, us long, times long", "Append", "EventTime")
    return out.select("tier", "key", "event_id", F.timestamp_micros("us").alias("ts"), "times")
