"""Several tables committed together, version by version.

A commit writes its rows to new folders and then one small manifest that names the folders of
every table; readers go by the newest manifest. Nothing that a manifest names is ever changed, so
a run that dies between the writes leaves folders that no reader sees, and the same batch can be
done again. The manifest also notes the last batch of each stream, so a batch that was committed
before its stream noted it is skipped when it comes again.

A keyed table's commit holds only the rows that are new, changed or deleted; a read takes each
key's newest row. After PARTS commits the next one writes the table whole. There is one writer at
a time: commits of one ``Snapshots`` object exclude each other.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage

PARTS = 8
DELETED = "_deleted"
#: A row's part, counted from the oldest, and the newest part that has its key.
PART, LAST = "_part", "_last"


@dataclass
class Table:
    """Where a table's rows are, oldest part first; ``key`` is None for one that only grows."""

    key: list[str] | None
    schema: str
    parts: list[str]


@dataclass
class Manifest:
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        tables = {n: {"key": t.key, "schema": json.loads(t.schema), "parts": t.parts} for n, t in self.tables.items()}
        return json.dumps({"version": self.version, "tables": tables, "applied": self.applied})

    @staticmethod
    def parsed(text: str) -> Manifest:
        m = json.loads(text)
        return Manifest(m["version"], {n: Table(t["key"], json.dumps(t["schema"]), t["parts"]) for n, t in m["tables"].items()}, m["applied"])


@dataclass
class Change:
    """Rows to put into a table and keys to delete from it."""

    put: DataFrame | None = None
    delete: DataFrame | None = None
    key: list[str] | None = None


class Snapshots:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._lock = threading.RLock()

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of a version; an empty one where nothing was committed."""
        names = storage.names(self.spark, f"{self.path}/manifests")
        wanted = [n for n in names if n.endswith(".json") and (version is None or int(n[:-5]) == version)]
        return Manifest.parsed(storage.read_text(self.spark, f"{self.path}/manifests/{max(wanted)}")) if wanted else Manifest()

    def read(self, name: str, version: int | None = None, only: DataFrame | None = None) -> DataFrame | None:
        """A table as of the newest version, or of an older one; None where it doesn't exist. With
        ``only``, a keyed table's rows with those keys, chosen in each part before parts meet."""
        table = self.manifest(version).tables.get(name)
        return None if table is None else self._rows(table, only).drop(DELETED)

    def since(self, name: str, version: int) -> DataFrame | None:
        """The rows that commits after a version have put into a keyed table, as they are now; all rows
        where the table has been written whole since. None where it doesn't exist."""
        now, then = self.manifest().tables.get(name), self.manifest(version).tables.get(name)
        if now is None:
            return None
        before = len(then.parts) if then and now.parts[: len(then.parts)] == then.parts else 0
        parts = now.parts[before:]
        return self._rows(Table(now.key, now.schema, parts or now.parts)).drop(DELETED).where(F.lit(bool(parts)))

    def _rows(self, table: Table, only: DataFrame | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table.schema))
        frames = [self.spark.read.schema(schema).parquet(f"{self.path}/{p}").withColumn(PART, F.lit(i)) for i, p in enumerate(table.parts)]
        if table.key is None:
            return reduce(DataFrame.unionByName, frames).drop(PART)
        # Old rows stay where they are; only the keys of newer parts, which are small, are joined, once for all old parts.
        out = [frames[-1]] if len(frames) == 1 else [reduce(DataFrame.unionByName, frames[:-1]), frames[-1]]
        if only is not None:
            out = [f.join(only, table.key, "left_semi") for f in out]
        if len(out) > 1:
            newer = reduce(DataFrame.unionByName, (f.select(*table.key, PART) for f in frames[1:]))
            # An outer join, as an anti join would be moved into each of the parts.
            old = out[0].join(newer.groupBy(*table.key).agg(F.max(PART).alias(LAST)), table.key, "left")
            out[0] = old.where(F.col(LAST).isNull() | (F.col(LAST) <= F.col(PART))).drop(LAST)
        out = reduce(DataFrame.unionByName, out).drop(PART)
        return out.where(~F.col(DELETED))

    def commit(self, stream: str, batch_id: int, plan: Callable[[], dict[str, Change]]) -> bool:
        """The changes that ``plan`` gives as one new version, unless this batch or a later one of
        the stream is in already. Plans run one after another, each over the last one's result."""
        with self._lock:
            now = self.manifest()
            if now.applied.get(stream, -1) >= batch_id:
                return False
            changes = plan()
            tables = dict(now.tables)
            for name, change in changes.items():
                tables[name] = self._written(name, change, now.tables.get(name))
            new = Manifest(now.version + 1, tables, now.applied | {stream: batch_id})
            storage.write_text(self.spark, f"{self.path}/manifests/{new.version:020d}.json", new.text())
            return True

    def _written(self, name: str, change: Change, old: Table | None) -> Table:
        key = old.key if old else change.key
        put = change.put
        if key is not None:
            put = None if put is None else put.withColumn(DELETED, F.lit(False))
            if change.delete is not None:
                gone = change.delete.select(*key).withColumn(DELETED, F.lit(True))
                # A key both deleted and put is put.
                put = gone if put is None else put.unionByName(gone.join(put.select(*key), key, "left_anti"), allowMissingColumns=True)
        if put is None:
            raise ValueError(f"nothing to write to {name}")
        if old is not None:
            schema = T.StructType.fromJson(json.loads(old.schema))
            put = put.select(*(F.col(f.name).cast(f.dataType) if f.name in put.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
        part = f"{name}/{uuid.uuid4().hex}"
        put.write.parquet(f"{self.path}/{part}")
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in put.schema])
        table = Table(key, json.dumps(nullable.jsonValue()), [*(old.parts if old else []), part])
        if key is not None and len(table.parts) > PARTS:
            whole = f"{name}/{uuid.uuid4().hex}"
            self._rows(table).write.parquet(f"{self.path}/{whole}")
            table.parts = [whole]
        return table

    def expire(self, keep: int = 2) -> None:
        """Delete manifests but the newest ``keep``, and folders that none of those names."""
        with self._lock:
            manifests = sorted(n for n in storage.names(self.spark, f"{self.path}/manifests") if n.endswith(".json"))
            for n in manifests[:-keep]:
                storage.remove(self.spark, f"{self.path}/manifests/{n}")
            named = {p for n in manifests[-keep:] for t in self.manifest(int(n[:-5])).tables.values() for p in t.parts}
            for table in storage.names(self.spark, self.path):
                for part in storage.names(self.spark, f"{self.path}/{table}") if table != "manifests" else []:
                    if f"{table}/{part}" not in named:
                        storage.remove(self.spark, f"{self.path}/{table}/{part}")
