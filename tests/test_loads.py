"""Load strategies: results, quirks and idempotency."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerflow.entries.registry import QUERIES
from ledgerflow.sources import audit, loads, sheets, sinks
from ledgerflow.sources.families import audit_log, load_family
from ledgerflow.sources.store import Store

D = dt.date
HEADER = "DocEntry int, UpdateDate date, UpdateTS int, v string"
CHILD = "DocEntry int, LineNum int, v string"


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


def test_upsert_mark_is_inclusive_and_idempotent(spark):
    schema = "k int, day date, v string"
    target = frame(spark, schema, (1, D(2026, 1, 1), "a"), (2, D(2026, 1, 5), "b"))
    src = frame(spark, schema, (1, D(2026, 1, 4), "late"), (2, D(2026, 1, 5), "b2"), (3, D(2026, 1, 6), "c"))
    once = loads.upsert_by_watermark(target, src, ["k"], "day")
    assert rows(once) == sorted([(1, D(2026, 1, 1), "a"), (2, D(2026, 1, 5), "b2"), (3, D(2026, 1, 6), "c")], key=repr)
    assert rows(loads.upsert_by_watermark(once, src, ["k"], "day")) == rows(once)
    empty = target.limit(0)
    assert rows(loads.upsert_by_watermark(empty, src, ["k"], "day")) == rows(src)
    floor = F.col("day") >= F.lit(D(2026, 1, 6))
    assert (2, D(2026, 1, 5), "b") in rows(loads.upsert_by_watermark(target, src, ["k"], "day", floor))


def test_composite_mark(spark):
    day = D(2026, 1, 5)
    target = frame(spark, HEADER, (50, day, 1200, "t"), (49, day, None, "t"), (7, None, 9000, "t"))
    mark = loads.capture_mark(target)
    assert (mark.day, mark.second, mark.key) == (day, 1200, 50)
    src = frame(spark, HEADER, (50, day, 1200, "out"), (10, day, 1300, "in"), (51, D(2026, 1, 4), 900, "in"))
    assert rows(loads.changed_rows(src, mark).select("DocEntry")) == [(10,), (51,)]
    assert loads.capture_mark(target.limit(0)).changed() is None


def test_family_reloads_children_of_changed_headers(spark):
    day, newer = D(2026, 1, 5), D(2026, 1, 6)
    target = {
        "h": frame(spark, HEADER, (10, day, 1, "a"), (11, day, 1, "a"), (12, day, 1, "a")),
        "l": frame(spark, CHILD, *[(10, n, "old") for n in (1, 2, 3)], (11, 1, "old"), (12, 1, "old")),
    }
    source = {
        "h": frame(spark, HEADER, (10, newer, 1, "b"), (11, newer, 1, "b"), (12, day, 1, "a")),
        "l": frame(spark, CHILD, (10, 1, "new"), (10, 2, "new"), (12, 1, "unseen")),
    }
    state = loads.load_family(target, source, "h")
    assert rows(state["h"].select("DocEntry", "v")) == [(10, "b"), (11, "b"), (12, "a")]
    # 10 shrinks to two lines, 11 lost all lines at the source and keeps its stale one
    assert rows(state["l"]) == [(10, 1, "new"), (10, 2, "new"), (11, 1, "old"), (12, 1, "old")]
    again = loads.load_family(state, source, "h")
    assert {k: rows(v) for k, v in again.items()} == {k: rows(v) for k, v in state.items()}


def test_append_replaces_the_last_day_only(spark):
    schema = "k int, day date"
    last = D(2026, 1, 5)
    target = frame(spark, schema, (1, D(2026, 1, 4)), *[(k, last) for k in (2, 3, 4)])
    src = frame(spark, schema, (1, D(2026, 1, 4)), *[(k, last) for k in (2, 3, 4, 5, 6)], (7, D(2026, 1, 6)), (8, D(2026, 1, 6)))
    once = loads.append_from_last_day(target, src, "day")
    assert rows(once) == rows(src)
    assert rows(loads.append_from_last_day(once, src, "day")) == rows(once)
    # a future-dated row pins the mark: older days are no longer refreshed
    pinned = target.unionByName(frame(spark, schema, (9, D(2030, 1, 1))))
    assert rows(loads.append_from_last_day(pinned, src, "day")) == sorted(rows(target), key=repr)


def test_merge_raises_on_a_repeated_source_key(spark):
    target = frame(spark, "k string, v string", ("A", "a"), ("B", "b"))
    src = frame(spark, "k string, v string, at int", ("B", "x", 1), ("B", "y", 2), ("C", "c", 1))
    with pytest.raises(PySparkException, match="more than once"):
        loads.merge_upsert(target, src, ["k"]).collect()
    assert rows(loads.merge_upsert(target, src, ["k"], newest=["at"])) == [("A", "a"), ("B", "y"), ("C", "c")]


def test_merge_never_deletes_and_keeps_target_columns(spark):
    target = frame(spark, "k string, v string, note string, at int", ("A", "a", "n1", 0), ("B", "b", "n2", 0))
    src = frame(spark, "k string, v string", ("B", None), ("C", "c"))
    merged = loads.merge_upsert(target, src, ["k"], "at", F.lit(5))
    assert rows(merged) == [("A", "a", "n1", 0), ("B", None, "n2", 5), ("C", "c", None, 5)]


def test_full_reload_is_versioned(spark, tmp_path):
    path = str(tmp_path / "t")
    src = frame(spark, "k int, v string", (1, "a"), (2, "b"))
    sinks.publish(loads.full_reload(src, ["k"], "k > 1"), path)
    assert rows(sinks.current(spark, path)) == [(2,)]
    # the next version may read the current one; a half-written version is ignored
    sinks.publish(sinks.current(spark, path).unionByName(src.select("k")), path)
    (tmp_path / "t" / "v00000009").mkdir()
    assert rows(sinks.current(spark, path)) == [(1,), (2,), (2,)]
    sinks.expire_versions(spark, path, keep=1)
    assert rows(sinks.current(spark, path)) == [(1,), (2,), (2,)]
    assert not (tmp_path / "t" / "v00000000").exists()


def test_append_days_and_bucketed_tables(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "k int, day date"
    sinks.append_days(frame(spark, schema, (1, D(2026, 1, 1)), (2, D(2026, 1, 2))), path, "day")
    assert sinks.last_day(spark, path, "day") == D(2026, 1, 2)
    sinks.append_days(frame(spark, schema, (3, D(2026, 1, 2)), (4, D(2026, 1, 3))), path, "day")
    assert rows(spark.read.parquet(path).select("k")) == [(1,), (3,), (4,)]

    a = sinks.bucketed(spark.range(100).withColumnRenamed("id", "k"), "bucketed_a", ["k"], 4)
    b = sinks.bucketed(spark.range(50).withColumnRenamed("id", "k"), "bucketed_b", ["k"], 4)
    joined = a.hint("merge").join(b, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


def test_sheet_types_and_snapshot(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("n,gap,flag,flag_gap,day,txt,none\n1,1,true,true,2026-01-01,a,\n2,,FALSE,,2026-01-02,b,\n3,3.5,true,true,,c,\n")
    sheet = sheets.read_export(spark, str(path))
    assert sheets.infer_column_types(sheet) == {
        "n": "bigint", "gap": "double", "flag": "boolean", "flag_gap": sheets.SHORT_TEXT, "day": "timestamp_ntz",
        "txt": sheets.SHORT_TEXT, "none": sheets.EMPTY_TEXT,
    }
    typed = sheets.sheet_snapshot(sheet, F.lit("2026-01-01 06:00:00"))
    first = typed.orderBy("n").first()
    assert (first.n, first.gap, first.flag, first._ingested_at) == (1, 1.0, True, dt.datetime(2026, 1, 1, 6))
    long = spark.createDataFrame([("x" * 4001,)], "t string")
    assert sheets.infer_column_types(long) == {"t": sheets.LONG_TEXT}


def test_sheet_file_in_parts_with_rejected_lines(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    body = ["code,name,n"] + [f"{i:03d},\"name \"\"{i}\"\", x\",{i}" for i in range(3000)]
    body[100:100] = ["7,too few", "8,a,b,too many", "9,\"open quote,1"]
    path.write_text("\n".join(body) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        typed, rejected = sheets.load_sheet(spark, str(path), F.lit("2026-01-01 06:00:00"))
        assert typed.rdd.getNumPartitions() > 2  # one file, several tasks
        assert typed.dtypes[:3] == [("code", "string"), ("name", "string"), ("n", "bigint")]
        first = typed.orderBy("n").first()
        assert (first.code, first.name, typed.count()) == ("000", 'name "0", x', 3000)
        assert [r[0] for r in rows(rejected.select("line"))] == ["7,too few", "8,a,b,too many", '9,"open quote,1']
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_codes_with_leading_zeros_stay_text(spark):
    df = spark.createDataFrame([("007", "0", "0.5", "-01"), ("012", "10", "10", "2")], "a string, b string, c string, d string")
    assert sheets.infer_column_types(df) == {"a": sheets.SHORT_TEXT, "b": "bigint", "c": "double", "d": sheets.SHORT_TEXT}


def _family(spark, day, v, lines):
    return {
        "h": frame(spark, HEADER, *[(k, day, 1, v) for k in (10, 11, 12)]),
        "l": frame(spark, CHILD, *[(k, n, v) for k in (10, 11, 12) for n in range(lines)]),
    }


def test_family_is_published_together_with_its_audit_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    day, newer = D(2026, 1, 5), D(2026, 1, 6)
    load_family(store, _family(spark, day, "a", 3), "h", "one")
    source = _family(spark, newer, "b", 2)
    bad = source | {"l": source["l"].withColumn("v", F.raise_error(F.lit("no connection")))}
    with pytest.raises(PySparkException):
        load_family(store, bad, "h", "two")
    # the header was written before the children failed, and is not visible
    assert {r.v for r in store.read("h").collect()} == {"a"} and store.read("l").count() == 9
    load_family(store, source, "h", "three")
    assert {r.v for r in store.read("h").collect()} == {"b"} and rows(store.read("l").select("DocEntry", "LineNum")) == [(k, n) for k in (10, 11, 12) for n in (0, 1)]
    log = rows(audit_log(store).select("execution_id", "table_name", "status", "row_count"))
    assert log == sorted([("one", "h", "success", 3), ("one", "l", "success", 9), ("two", "l", "error", None), ("three", "h", "success", 3), ("three", "l", "success", 6)], key=repr)
    assert "no connection" in audit_log(store).where("status = 'error'").first().error_message
    same = load_family(store, source, "h", "four")
    assert {r.v for r in store.read("h", same).collect()} == {"b"} and store.read("l").count() == 6


NOW = dt.datetime(2026, 1, 1, 12, 0)
LOG = "id int, table_name string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, row_count int, error_message string"


def log(spark):
    at = lambda h, m=0: dt.datetime(2026, 1, 1, h, m)
    return frame(
        spark, LOG, (1, "a", at(8), at(9), "error", None, "x"), (2, "a", at(10), at(10, 5), "success", 5, None),
        (3, "b", at(10), None, "running", None, None), (4, "c", at(11), None, "running", None, None),
        (5, "d", at(9), at(9, 30), "interrupted", None, "y"),
    )


def test_fold_keeps_only_messages_that_are_shown(spark):
    """One shuffle, without the texts of events that are no error; a load without a table name is a load, too."""
    at = lambda minute: dt.datetime(2024, 1, 1, 0, minute)
    events = [("r", "a", at(0), 1, "running", 0, "x"), ("r", "a", at(2), 2, "error", 7, "whole"), ("r", "b", at(1), 3, "error", 0, "old"),
              ("r", "b", at(1), 4, "success", 9, "fine"), ("r", None, at(3), 5, "running", 0, "y")]
    df = spark.createDataFrame(events, "execution_id string, table_name string, at timestamp_ntz, event_id long, status string, row_count long, message string")
    folded = audit.fold_status(df)
    assert rows(folded) == sorted([
        ("r", "a", at(0), at(2), "error", None, "whole"), ("r", "b", at(1), at(1), "success", 9, None), ("r", None, at(3), None, "running", None, None),
    ], key=repr)
    plan = folded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and "CASE WHEN" in plan.split("Exchange")[1]


def test_audit_reports(spark):
    assert rows(audit.issues(log(spark), NOW).select("table_name", "diagnosis", "elapsed_min")) == [
        ("b", "stuck", 120), ("d", "interrupted", 30),
    ]
    healed = audit.cleanup_orphans(log(spark), NOW)
    assert rows(healed.where("status = 'interrupted'").select("id")) == [(3,), (5,)]
    assert rows(audit.cleanup_orphans(healed, NOW)) == rows(healed)
    starts = frame(spark, "table_name string, new_start timestamp_ntz", ("c", NOW))
    assert rows(audit.self_heal(log(spark), starts).where("id = 4").select("status", "finished_at")) == [("interrupted", NOW)]
    summary = audit.round_summary(log(spark), NOW).first()
    assert (summary.tables, summary.success, summary.error, summary.running, summary.total_sec) == (5, 1, 1, 2, 14400)


@pytest.mark.parametrize(("rows_before", "rows_after", "delta"), [(3, 3, 0), (3, 1, -2)])
def test_count_comparison(spark, rows_before, rows_after, delta):
    before = loads.row_counts({"t": spark.range(rows_before)})
    after = loads.row_counts({"t": spark.range(rows_after)})
    assert rows(loads.compare_counts(before, after)) == [("t", rows_before, rows_after, delta)]


def test_mark_and_types_stay_plans(spark, sf_dir):
    """Both answers are aggregates over a scan, not rows made in the driver."""
    for key in ("capture_watermark", "infer_column_types"):
        plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "LocalTableScan" not in plan and "ExistingRDD" not in plan, key
    empty = spark.createDataFrame([], "UpdateDate date, UpdateTS int, DocEntry bigint")
    assert rows(loads.mark_row(empty)) == [(None, 0, 0)]
