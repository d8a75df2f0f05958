"""Stored tables under one manifest: several tables change together, or not at all.

A table is dealt over a fixed number of buckets by the hash of its key. A change
writes new files for the buckets it touches and leaves all others where they
are; nothing is visible until the next manifest is in place, which names every
bucket's files, so a failure on the way leaves the old tables readable and a
reader that holds a version keeps reading it. What a change did is logged in the
manifest that makes it visible.

A table may also have segments: change batches laid beside the buckets, newest
version per key to be found when read. `compact` moves them into the buckets.

Everything is in the cluster's file system; the driver handles file names only,
as many as there are buckets.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.latest import latest_per_key
from ledgerflow.operators.skew import anti_join
from ledgerflow.sources.loads import merge_upsert

BUCKETS = 64


class VersionConflict(RuntimeError):
    """Another writer put the next manifest in place first."""


@dataclass(frozen=True)
class Version:
    """What one manifest says; -1 is the empty store."""

    number: int = -1
    tables: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    log: Sequence[Mapping[str, Any]] = ()


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._hadoop("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _hadoop(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        path = self._hadoop(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in self._names("manifests") if n.startswith("v") and n.endswith(".json")]

    def version(self, number: int | None = None) -> Version:
        """A version, the newest if no number is given."""
        if number is None:
            known = self.numbers()
            if not known:
                return Version()
            number = known[-1]
        stream = self._fs.open(self._hadoop(f"manifests/v{number:010d}.json"))
        try:
            body = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, body["tables"], body["log"])

    def _commit(self, base: int, tables: Mapping, log: Sequence[Mapping]) -> Version:
        number = base + 1
        target, part = self._hadoop(f"manifests/v{number:010d}.json"), self._hadoop(f"manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps({"tables": tables, "log": list(log)}, default=str).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(part, target):
            self._fs.delete(part, False)
            raise VersionConflict(f"{self.path}: version {number} exists")
        return Version(number, tables, log)

    def read(self, name: str, version: Version | None = None) -> DataFrame:
        """A table as of a version; with segments, the newest row per key."""
        table = (version or self.version()).tables[name]
        rows = self._files(table, table["files"].values())
        if not table["segments"]:
            return rows
        changes = self._files(table, [s["path"] for s in table["segments"]])
        return latest_per_key(rows.unionByName(changes), table["keys"], *table["newest"])

    def _files(self, table: Mapping, names) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table["schema"]))
        paths = [f"{self.path}/{n}" for n in names]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def log(self) -> list[dict]:
        """What every change logged, oldest first."""
        return [dict(row, version=n) for n in self.numbers() for row in self.version(n).log]

    def change(self) -> Change:
        return Change(self, self.version())

    def sweep(self, keep: int = 2) -> None:
        """Delete the files that none of the newest `keep` versions names. Manifests stay: they hold the log."""
        used = set()
        for number in self.numbers()[-max(keep, 1) :]:
            for table in self.version(number).tables.values():
                used |= {*table["files"].values(), *(s["path"] for s in table["segments"])}
        for name in self._names("data"):
            inside = [f"data/{name}/{b}" for b in self._names(f"data/{name}") if b.startswith("_bucket=")]
            kept = [b for b in inside if b in used] or f"data/{name}" in used
            for path in [b for b in inside if b not in used] if kept else [f"data/{name}"]:
                self._fs.delete(self._hadoop(path), True)


class Change:
    """New states of some tables of a store; `commit` makes them visible together."""

    def __init__(self, store: Store, base: Version):
        self.store, self.base = store, base
        self.tables: dict[str, dict] = {k: dict(v) for k, v in base.tables.items()}

    def _bucket(self, table: Mapping) -> Column:
        return F.pmod(F.xxhash64(*table["keys"]), F.lit(table["buckets"])).cast("int")

    def _written(self, table: dict, rows: DataFrame) -> dict[str, str]:
        """Write rows by bucket; the folder of every bucket that has some."""
        name = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("_bucket", self._bucket(table)).hint("rebalance", "_bucket")
        dealt.write.partitionBy("_bucket").parquet(f"{self.store.path}/{name}")
        # a folder may be missing where nothing was written
        return {n.split("=")[1]: f"{name}/{n}" for n in self.store._names(name) if n.startswith("_bucket=")}

    def create(self, name: str, rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS, newest: Sequence[str] = ()) -> None:
        """A new table, or a full reload of an old one. `newest` orders the versions of a key in segments."""
        table = {"schema": rows.schema.json(), "keys": list(keys), "buckets": buckets, "newest": list(newest), "segments": [], "batches": {}}
        self.tables[name] = table | {"files": self._written(table, rows)}

    def count(self, name: str) -> int:
        """Rows of a table's new state, from its files."""
        return self.store._files(self.tables[name], self.tables[name]["files"].values()).count()

    def _touched(self, table: Mapping, changes: DataFrame) -> list[str]:
        """Buckets that hold keys of the changes; as many numbers as there are buckets, at most."""
        return [str(r[0]) for r in changes.select(self._bucket(table).alias("b")).distinct().collect()]

    def _types(self, table: Mapping) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in T.StructType.fromJson(json.loads(table["schema"])).fields}

    def _typed(self, table: Mapping, rows: DataFrame, also: Sequence[str] = ()) -> DataFrame:
        """The table's columns in its types, as hashes of equal keys must be equal, and others as they are."""
        kinds = self._types(table)
        return rows.select(*(F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else c for c in rows.columns if c in kinds or c in also))

    def _staged(self, rows: DataFrame) -> DataFrame:
        """The rows, written once: a source that is read several times must not change in between. Swept with old files."""
        path = f"{self.store.path}/data/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.store.spark.read.schema(rows.schema).parquet(path)

    def _rewrite(self, name: str, touched: Sequence[str], old_to_new) -> None:
        table = self.tables[name]
        old = self.store._files(table, [table["files"][b] for b in touched if b in table["files"]])
        files = {b: p for b, p in table["files"].items() if b not in set(touched)}
        table["files"] = files | self._written(table, old_to_new(old))

    def merge(self, name: str, src: DataFrame, newest: Sequence[str] = (), stamp: str | None = None, run_ts: Column | None = None) -> None:
        """MERGE without delete; see `loads.merge_upsert`. Only the buckets of the source's keys are rewritten."""
        table = self.tables[name]
        typed = self._staged(self._typed(table, src, newest))
        touched = self._touched(table, typed)
        if touched:
            self._rewrite(name, touched, lambda old: merge_upsert(old, typed, table["keys"], stamp, run_ts, newest))

    def replace_by_key(self, name: str, delta: DataFrame) -> int:
        """Drop the rows whose key the delta carries, then add the delta; only its buckets are rewritten. Returns its rows."""
        table = self.tables[name]
        typed = self._staged(self._typed(table, delta))
        columns = list(self._types(table))
        touched = self._touched(table, typed)
        if touched:
            self._rewrite(name, touched, lambda old: anti_join(old, typed, table["keys"]).select(*columns).unionByName(typed.select(*columns)))
        return typed.count()

    def append_segment(self, name: str, rows: DataFrame, batch: int, stream: str = "") -> bool:
        """Lay a batch's newest rows beside the table; a batch of the stream that is in already is left out."""
        table = self.tables[name]
        if batch <= table["batches"].get(stream, -1):
            return False
        path = f"data/{uuid.uuid4().hex}"
        latest_per_key(self._typed(table, rows), table["keys"], *table["newest"]).write.parquet(f"{self.store.path}/{path}")
        table["segments"] = [*table["segments"], {"batch": batch, "path": path}]
        table["batches"] = {**table["batches"], stream: batch}
        return True

    def commit(self, log: Sequence[Mapping] = ()) -> Version:
        return self.store._commit(self.base.number, self.tables, log)


def compact(store: Store, name: str, tries: int = 5) -> Version:
    """Move a table's segments into its buckets; batches that come in meanwhile stay beside them.

    Only the buckets with changed keys are rewritten. Where a writer was faster
    the result is laid on top of the newer version: its segments are those that
    this run did not merge, its buckets are still the ones that it read.
    """
    change = store.change()
    table = change.tables[name]
    merged = [s["path"] for s in table["segments"]]
    if not merged:
        return change.base
    before = dict(table["files"])
    rows = store._files(table, merged)
    change._rewrite(name, change._touched(table, rows), lambda old: latest_per_key(old.unionByName(rows), table["keys"], *table["newest"]))
    for _ in range(tries):
        now = store.version()
        theirs = dict(now.tables[name])
        if theirs["files"] != before:
            raise VersionConflict(f"{store.path}: {name} was rewritten by another change")
        theirs |= {"files": change.tables[name]["files"], "segments": [s for s in theirs["segments"] if s["path"] not in merged]}
        try:
            return store._commit(now.number, {**now.tables, name: theirs}, [{"change": "compact", "table_name": name, "segments": len(merged)}])
        except VersionConflict:
            continue
    raise VersionConflict(f"{store.path}: {tries} tries")
