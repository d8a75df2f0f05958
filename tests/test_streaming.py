"""The streaming forms, driven from files to completion."""

from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.session import shared_folder
from ledgerflow.sources.store import Store, compact
from ledgerflow.streaming.daily_close import closed_day_flow, rebuild_late_days, start_daily_close
from ledgerflow.streaming.upsert_latest import newest_of, newest_state, start_upsert, start_upsert_table

SCHEMA = "ts timestamp, item string, qty int"


def write_batch(spark, path, name, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def at(day, hour=12):
    return dt.datetime(2026, 1, day, hour)


def test_days_come_out_once_closed(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    check = shared_folder(spark, str(tmp_path / "state"))

    def run():
        feed = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        query = (
            closed_day_flow(feed, "ts", ["item"], "qty")
            .writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
            .outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination(120)
        return rows(spark.read.parquet(out)) if (tmp_path / "out").exists() else []

    write_batch(spark, source, "a", [(at(1), "x", 5), (at(1, 13), "x", 2), (at(2), "x", 1)])
    first = run()
    assert first == [(dt.date(2026, 1, 1), "x", 7, 2)]  # the 2nd is still open
    # a row for the closed 1st comes late and is dropped; the 3rd closes the 2nd
    write_batch(spark, source, "b", [(at(1, 14), "x", 100), (at(2, 15), "x", 4), (at(3), "x", 9)])
    assert run() == [(dt.date(2026, 1, 1), "x", 7, 2), (dt.date(2026, 1, 2), "x", 5, 2)]


def test_batch_form_equals_plain_grouping(spark):
    df = spark.createDataFrame([(at(1), "x", 5), (at(1, 23), "x", 2), (at(2), "y", 1)], SCHEMA)
    assert rows(closed_day_flow(df, "ts", ["item"], "qty")) == [
        (dt.date(2026, 1, 1), "x", 7, 2), (dt.date(2026, 1, 2), "y", 1, 1),
    ]


def test_late_rows_wait_aside_and_days_are_rebuilt(spark, tmp_path):
    source, folder, check = str(tmp_path / "in"), str(tmp_path / "close"), str(tmp_path / "state")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        feed = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        start_daily_close(feed, folder, check, "ts", ["item"], "qty").awaitTermination(120)
        return rows(spark.read.parquet(f"{folder}/days").drop("_day")) if (tmp_path / "close" / "days").exists() else []

    d = lambda n: dt.date(2026, 1, n)
    write_batch(spark, source, "a", [(at(1), "x", 5), (at(1, 13), "x", 2), (at(2), "x", 1), (None, "x", 50)])
    assert run() == [(d(1), "x", 7, 2)]
    write_batch(spark, source, "b", [(at(1, 14), "x", 100), (at(2, 15), "x", 4), (at(3), "x", 9)])
    assert run() == [(d(1), "x", 7, 2), (d(2), "x", 5, 2)]
    late = spark.read.parquet(f"{folder}/late")
    assert rows(late.select("ts", "qty")) == [(at(1, 14), 100)]
    write_batch(spark, source, "c", [(at(1, 15), "y", 3), (at(3, 1), "x", 1)])
    run()
    untouched = sorted(p.name for p in (tmp_path / "close" / "days" / "_day=2026-01-02").glob("*.parquet"))
    assert rebuild_late_days(spark, folder, schema, ["item"], "qty") == [d(1)]
    want = [(d(1), "x", 107, 3), (d(1), "y", 3, 1), (d(2), "x", 5, 2)]
    assert rows(spark.read.parquet(f"{folder}/days").drop("_day")) == want
    assert sorted(p.name for p in (tmp_path / "close" / "days" / "_day=2026-01-02").glob("*.parquet")) == untouched
    assert rebuild_late_days(spark, folder, schema, ["item"], "qty") == []
    kept = spark.read.parquet(f"{folder}/rows").select("qty").unionAll(late.select("qty"))
    assert sorted(r[0] for r in kept.collect() + spark.read.parquet(f"{folder}/late").where("item = 'y'").select("qty").collect()) == [1, 1, 2, 3, 4, 5, 9, 50, 100]


def test_daily_close_replays_a_batch(spark, tmp_path):
    """The stream forgets its progress: the same batches part and publish their rows as before."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "close")

    def run(state):
        feed = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(source)
        start_daily_close(feed, folder, str(tmp_path / state), "ts", ["item"], "qty", late_days=1).awaitTermination(120)
        days = rows(spark.read.parquet(f"{folder}/days").drop("_day"))
        return days, rows(spark.read.parquet(f"{folder}/rows").select("ts", "qty")), rows(spark.read.parquet(f"{folder}/late").select("ts", "qty"))

    for n, data in enumerate([[(at(1), "x", 1)], [(at(3), "x", 2), (at(1, 15), "x", 4)], [(at(1), "x", 8), (at(4), "x", 3), (at(2), "x", 6)]]):
        write_batch(spark, source, f"b{n}", data)
    first = run("one")
    assert first[0] == [(dt.date(2026, 1, 1), "x", 5, 2), (dt.date(2026, 1, 2), "x", 6, 1)] and first[2] == [(at(1), 8)]
    assert run("two") == first


def test_upsert_stream_into_a_table_that_is_compacted(spark, tmp_path):
    source, check = str(tmp_path / "in"), str(tmp_path / "state")
    store = Store(spark, str(tmp_path / "store"))
    change = store.change()
    change.create("t", spark.createDataFrame([(at(1), "x", 0), (at(1), "w", 7)], SCHEMA), ["item"], buckets=4, newest=["ts", "qty"])
    change.commit()

    def run(state=check):
        feed = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        start_upsert_table(feed, store, "t", state).awaitTermination(120)
        return rows(store.read("t").select("item", "qty"))

    write_batch(spark, source, "a", [(at(1), "x", 1), (at(2), "x", 2), (at(1), "y", 3)])
    assert run() == [("w", 7), ("x", 2), ("y", 3)]
    write_batch(spark, source, "b", [(at(1, 5), "x", 9), (at(3), "y", 4), (at(1), "z", 5)])
    assert run() == [("w", 7), ("x", 2), ("y", 4), ("z", 5)]
    held = store.version()
    assert len(held.tables["t"]["segments"]) == 2
    version = compact(store, "t")
    assert version.tables["t"]["segments"] == []
    assert rows(store.read("t", held)) == rows(store.read("t")) and store.read("t").count() == 4
    store.sweep(keep=1)
    files = list((tmp_path / "store" / "data").rglob("*.parquet"))
    assert sum(spark.read.parquet(str(f)).count() for f in files) == 4  # the log has shrunk to one row per key
    # the stream forgets its progress and sends its batches again
    run(str(tmp_path / "again"))
    assert rows(store.read("t").select("item", "qty")) == [("w", 7), ("x", 2), ("y", 4), ("z", 5)]


def test_upsert_stream_keeps_the_newest_version(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    check = str(tmp_path / "state")

    def run():
        feed = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(source)
        start_upsert(feed, table, check, ["item"], "ts", "qty").awaitTermination(120)
        return rows(newest_state(spark, table, ["item"], "ts", "qty").select("item", "qty"))

    write_batch(spark, source, "a", [(at(1), "x", 1), (at(2), "x", 2), (at(1), "y", 3)])
    assert run() == [("x", 2), ("y", 3)]
    write_batch(spark, source, "b", [(at(1, 5), "x", 9), (at(3), "y", 4), (at(1), "z", 5)])
    assert run() == [("x", 2), ("y", 4), ("z", 5)]
    # a replayed batch only repeats rows of the log
    spark.read.parquet(table).write.mode("append").parquet(table)
    assert run() == [("x", 2), ("y", 4), ("z", 5)]
    state = newest_state(spark, table, ["item"], "ts", "qty")
    assert rows(newest_of(state, state.where(F.col("item") == "x"), ["item"], "ts", "qty")) == rows(state)
