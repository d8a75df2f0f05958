"""Stored tables: MERGE by bucket, several tables in one commit, segments and their compaction."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerflow.sources import store as stores
from ledgerflow.sources.store import Store, VersionConflict, compact

ITEMS = "k string, v string, note string, at int"


@pytest.fixture
def table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    change = store.change()
    change.create("t", spark.range(200).selectExpr("concat('k', id) AS k", "'old' AS v", "concat('n', id) AS note", "0 AS at"), ["k"], buckets=16)
    change.commit()
    return store


def test_merge_rewrites_only_touched_buckets(spark, table):
    before = table.version().tables["t"]["files"]
    src = spark.createDataFrame([("k7", "new"), ("x1", "added")], "k string, v string")
    change = table.change()
    change.merge("t", src, stamp="at", run_ts=F.lit(5))
    version = change.commit([{"change": "merge", "rows": 2}])
    after = version.tables["t"]["files"]
    moved = {b for b in after if after[b] != before.get(b)}
    hits = {str(r[0]) for r in src.select(F.pmod(F.xxhash64("k"), F.lit(16)).cast("string")).collect()}
    assert moved == hits and len(before) == 16 and len(moved) <= 2
    got = {r["k"]: tuple(r)[1:] for r in table.read("t").collect()}
    assert len(got) == 201 and got["k7"] == ("new", "n7", 5) and got["x1"] == ("added", None, 5) and got["k8"] == ("old", "n8", 0)
    # the older version reads as before, until it is swept
    assert table.read("t", table.version(0)).where("v <> 'old'").count() == 0
    assert [(r["change"], r["version"]) for r in table.log()] == [("merge", 1)]
    table.sweep(keep=1)
    assert table.read("t").count() == 201
    with pytest.raises(PySparkException):
        table.read("t", table.version(0)).count()


def test_merge_repeated_source_key_raises_or_takes_the_newest(spark, table):
    src = spark.createDataFrame([("k7", "a", 1), ("k7", "b", 3), ("k7", "c", 2), (None, "n", 1), (None, "m", 1), (None, "m", 1)], "k string, v string, seen int")
    change = table.change()
    with pytest.raises(PySparkException, match="more than once"):
        change.merge("t", src)
    assert table.version().number == 0 and table.read("t").where("v <> 'old'").count() == 0
    change = table.change()
    change.merge("t", src, newest=["seen"])
    change.commit()
    assert rows(table.read("t").where("v <> 'old'").select("k", "v", "note")) == sorted([("k7", "b", "n7"), (None, "n", None), (None, "m", None), (None, "m", None)], key=repr)


def test_merge_casts_keys_to_the_table(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    change = store.change()
    change.create("t", spark.range(50).selectExpr("id AS k", "0 AS v"), ["k"], buckets=4)
    change.merge("t", spark.createDataFrame([(3, 9)], "k int, v int"))
    change.commit()
    assert rows(store.read("t").where("v <> 0")) == [(3, 9)] and store.read("t").count() == 50


def test_tables_change_together_or_not_at_all(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    change = store.change()
    change.create("h", spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    change.create("l", spark.createDataFrame([(1, 1)], "k int, n int"), ["k"])
    change.commit()
    change = store.change()
    change.replace_by_key("h", spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string"))
    bad = spark.createDataFrame([(1, 2)], "k int, n int").withColumn("n", F.raise_error(F.lit("source is gone")).cast("int"))
    with pytest.raises(PySparkException):
        change.replace_by_key("l", bad)
    assert rows(store.read("h")) == [(1, "a")] and rows(store.read("l")) == [(1, 1)]
    # two writers from one version: the second is told
    first, second = store.change(), store.change()
    first.replace_by_key("h", spark.createDataFrame([(1, "c")], "k int, v string"))
    first.commit()
    second.replace_by_key("h", spark.createDataFrame([(1, "d")], "k int, v string"))
    with pytest.raises(VersionConflict):
        second.commit()
    assert rows(store.read("h")) == [(1, "c")]


def test_replace_by_a_part_of_the_key(spark, tmp_path):
    """All children of a header go, whatever their own key; the table is dealt by the header."""
    store = Store(spark, str(tmp_path / "s"))
    change = store.change()
    change.create("l", spark.createDataFrame([(1, n, "old") for n in range(5)] + [(2, 0, "old")], "doc int, n int, v string"), ["doc"])
    change.replace_by_key("l", spark.createDataFrame([(1, 0, "new"), (1, 1, "new")], "doc int, n int, v string"))
    change.commit()
    assert rows(store.read("l")) == [(1, 0, "new"), (1, 1, "new"), (2, 0, "old")]


def _batch(spark, n, *data):
    return spark.createDataFrame(list(data), "k string, at int, v string")


def test_compaction_under_a_reader_and_a_writer(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    change = store.change()
    change.create("t", _batch(spark, 0, *[(f"k{i}", 0, "base") for i in range(40)]), ["k"], buckets=8, newest=["at", "v"])
    change.commit()
    for n, data in enumerate([[("k1", 1, "a"), ("k1", 2, "b")], [("k2", 1, "c"), ("x", 1, "d")], [("k1", 1, "late")]]):
        change = store.change()
        assert change.append_segment("t", _batch(spark, n, *data), n)
        change.commit()
    change = store.change()
    assert not change.append_segment("t", _batch(spark, 2, ("k9", 9, "replayed")), 2)  # a batch that is in already
    held = store.version()
    want = rows(store.read("t"))
    assert ("k1", 2, "b") in want and ("x", 1, "d") in want and len(want) == 41

    # a batch comes in while the segments are merged
    real = stores.Change._rewrite

    def slow(self, *args):
        real(self, *args)
        other = store.change()
        other.append_segment("t", _batch(spark, 3, ("k3", 5, "meanwhile")), 3)
        other.commit()

    monkeypatch.setattr(stores.Change, "_rewrite", slow)
    version = compact(store, "t")
    monkeypatch.setattr(stores.Change, "_rewrite", real)
    assert [s["batch"] for s in version.tables["t"]["segments"]] == [3] and version.tables["t"]["batches"] == {"": 3}
    assert rows(store.read("t", held)) == want
    assert rows(store.read("t")) == sorted([r for r in want if r[0] != "k3"] + [("k3", 5, "meanwhile")], key=repr)
    version = compact(store, "t")
    assert version.tables["t"]["segments"] == [] and compact(store, "t").number == version.number
    stored = store._files(version.tables["t"], version.tables["t"]["files"].values())
    assert stored.count() == 41  # one row per key: the log is gone
    untouched = held.tables["t"]["files"]
    assert sum(version.tables["t"]["files"].get(b) == p for b, p in untouched.items()) >= 4
