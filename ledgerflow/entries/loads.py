"""Registered load strategies, sheet loads and audit reports."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ledgerflow.entries.base import query
from ledgerflow.session import work_folder
from ledgerflow.sources import audit, loads, sheets, sinks
from ledgerflow.sources.families import audit_log, load_family
from ledgerflow.sources.staging import stamp_ingested_at
from ledgerflow.sources.store import Store

# ---- splits of driver tables into an older target and a newer source --------

_EVENT_TARGET = """
SELECT event_id, CAST(ts AS DATE) AS day, user_id, event_type, value
FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'"""
_EVENT_SOURCE = """
SELECT event_id, CAST(ts AS DATE) AS day, user_id, event_type,
       CASE WHEN event_id % 5 = 0 THEN value + 100 ELSE value END AS value
FROM events"""
_EVENT_OUT = "event_id, CAST(day AS VARCHAR) AS day, user_id, event_type, value"


def event_target(t):
    return t.events.selectExpr("event_id", "CAST(ts AS DATE) AS day", "user_id", "event_type", "value").where(
        "day <= DATE '2024-01-20'"
    )


def event_source(t):
    return t.events.selectExpr(
        "event_id", "CAST(ts AS DATE) AS day", "user_id", "event_type",
        "CASE WHEN event_id % 5 = 0 THEN value + 100 ELSE value END AS value",
    )


_HEADER = """o_orderkey AS DocEntry, CAST(o_orderdate AS DATE) AS UpdateDate,
       CAST((o_orderkey * 7) % 240000 AS INTEGER) AS UpdateTS, o_custkey AS CardCode"""
_MOVED = "CASE WHEN o_orderkey % 97 = 5 THEN DATE '2001-08-01' + 1 ELSE CAST(o_orderdate AS DATE) END"
_HEADER_TARGET = f"SELECT {_HEADER}, o_totalprice AS DocTotal FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01'"
_HEADER_SOURCE = f"""
SELECT o_orderkey AS DocEntry, {_MOVED} AS UpdateDate, CAST((o_orderkey * 7) % 240000 AS INTEGER) AS UpdateTS,
       o_custkey AS CardCode, o_totalprice + 1 AS DocTotal FROM orders"""


def header_target(t):
    return t.orders.where("o_orderdate < TIMESTAMP_NTZ '2001-07-01 00:00:00'").selectExpr(
        "o_orderkey AS DocEntry", "CAST(o_orderdate AS DATE) AS UpdateDate",
        "CAST((o_orderkey * 7) % 240000 AS INT) AS UpdateTS", "o_custkey AS CardCode", "o_totalprice AS DocTotal",
    )


def header_source(t):
    return t.orders.selectExpr(
        "o_orderkey AS DocEntry",
        "CASE WHEN o_orderkey % 97 = 5 THEN date_add(DATE '2001-08-01', 1) ELSE CAST(o_orderdate AS DATE) END AS UpdateDate",
        "CAST((o_orderkey * 7) % 240000 AS INT) AS UpdateTS", "o_custkey AS CardCode", "o_totalprice + 1 AS DocTotal",
    )


_CHILD = "l_orderkey AS DocEntry, l_linenumber AS LineNum, l_partkey AS ItemKey"


def child_target(t):
    return t.lineitem.where("l_shipdate < TIMESTAMP_NTZ '2001-07-01 00:00:00'").selectExpr(
        "l_orderkey AS DocEntry", "l_linenumber AS LineNum", "l_partkey AS ItemKey", "l_quantity AS Quantity"
    )


def child_source(t):
    return t.lineitem.selectExpr(
        "l_orderkey AS DocEntry", "l_linenumber AS LineNum", "l_partkey AS ItemKey", "l_quantity + 1 AS Quantity"
    )


_MARK = f"""mark AS (
    SELECT max(UpdateDate) AS d, (SELECT max(UpdateTS) FROM ht WHERE UpdateDate = (SELECT max(UpdateDate) FROM ht)) AS s,
           max(DocEntry) AS k FROM ht)"""
_FAMILY = f"""WITH ht AS ({_HEADER_TARGET}), hs AS ({_HEADER_SOURCE}), {_MARK},
changed AS (SELECT hs.* FROM hs, mark WHERE UpdateDate > d OR (UpdateDate = d AND UpdateTS > s) OR DocEntry > k)"""


@query(
    "load_full_reload",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'",
)
def _full_reload(t):
    return loads.full_reload(
        t.lineitem, ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"],
        "l_shipdate >= TIMESTAMP_NTZ '1998-01-01 00:00:00'",
    )


@query(
    "scan_projected_filtered",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000 AND o_orderstatus = 'F'",
)
def _scan(t):
    return loads.scan(t.orders, ["o_orderkey", "o_totalprice"], "o_totalprice > 250000D AND o_orderstatus = 'F'")


@query(
    "load_upsert_watermark",
    f"""WITH tgt AS ({_EVENT_TARGET}), delta AS (
        SELECT * FROM ({_EVENT_SOURCE}) WHERE day >= (SELECT max(day) FROM tgt))
    SELECT {_EVENT_OUT} FROM tgt WHERE event_id NOT IN (SELECT event_id FROM delta)
    UNION ALL SELECT {_EVENT_OUT} FROM delta""",
)
def _upsert(t):
    return loads.upsert_by_watermark(event_target(t), event_source(t), ["event_id"], "day")


@query(
    "load_volume_cutoff",
    f"""WITH tgt AS ({_EVENT_TARGET}), delta AS (
        SELECT * FROM ({_EVENT_SOURCE}) WHERE day >= (SELECT max(day) FROM tgt) AND day >= DATE '2024-01-25')
    SELECT {_EVENT_OUT} FROM tgt WHERE event_id NOT IN (SELECT event_id FROM delta)
    UNION ALL SELECT {_EVENT_OUT} FROM delta""",
)
def _cutoff(t):
    floor = F.col("day") >= F.lit(dt.date(2024, 1, 25))
    return loads.upsert_by_watermark(event_target(t), event_source(t), ["event_id"], "day", floor)


@query(
    "load_upsert_composite",
    f"""{_FAMILY}
    SELECT DocEntry, CAST(UpdateDate AS VARCHAR) AS UpdateDate, UpdateTS, CardCode, DocTotal FROM (
        SELECT * FROM ht WHERE DocEntry NOT IN (SELECT DocEntry FROM changed) UNION ALL SELECT * FROM changed)""",
)
def _composite(t):
    target = header_target(t)
    return loads.upsert_headers(target, header_source(t), loads.capture_mark(target))


@query(
    "load_via_header",
    f"""{_FAMILY}, delta AS (
        SELECT {_CHILD}, l_quantity + 1 AS Quantity FROM lineitem
        WHERE l_orderkey IN (SELECT DocEntry FROM changed))
    SELECT {_CHILD}, l_quantity AS Quantity FROM lineitem
    WHERE l_shipdate < TIMESTAMP '2001-07-01' AND l_orderkey NOT IN (SELECT DocEntry FROM delta)
    UNION ALL SELECT * FROM delta""",
)
def _via_header(t):
    target = {"header": header_target(t), "lines": child_target(t)}
    source = {"header": header_source(t), "lines": child_source(t)}
    return loads.load_family(target, source, "header")["lines"]


@query(
    "load_family_stored",
    f"""{_FAMILY}, delta AS (
        SELECT {_CHILD}, l_quantity + 1 AS Quantity FROM lineitem
        WHERE l_orderkey IN (SELECT DocEntry FROM changed))
    SELECT {_CHILD}, l_quantity AS Quantity FROM lineitem
    WHERE l_shipdate < TIMESTAMP '2001-07-01' AND l_orderkey NOT IN (SELECT DocEntry FROM delta)
    UNION ALL SELECT * FROM delta""",
)
def _family_stored(t):
    """Lines after a first load and a second one, as the store publishes them."""
    return _loaded_family(t).read("lines")


@query(
    "load_family_audit",
    f"""{_FAMILY}
    SELECT 'first' AS execution_id, 'header' AS table_name, 'full_reload' AS strategy, 'success' AS status, count(*) AS row_count FROM ht
    UNION ALL SELECT 'first', 'lines', 'full_reload', 'success', count(*) FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-07-01'
    UNION ALL SELECT 'second', 'header', 'upsert', 'success', count(*) FROM changed
    UNION ALL SELECT 'second', 'lines', 'via_header', 'success', count(*) FROM lineitem
    WHERE l_orderkey IN (SELECT DocEntry FROM changed)""",
)
def _family_audit(t):
    return audit_log(_loaded_family(t)).select("execution_id", "table_name", "strategy", "status", "row_count")


def _loaded_family(t):
    store = Store(t.spark, f"{work_folder(t.spark)}/store/{uuid.uuid4().hex}")
    load_family(store, {"header": header_target(t), "lines": child_target(t)}, "header", "first")
    load_family(store, {"header": header_source(t), "lines": child_source(t)}, "header", "second")
    return store


@query(
    "load_append_cutoff_day",
    f"""WITH tgt AS ({_EVENT_TARGET}), mark AS (SELECT max(day) AS d FROM tgt)
    SELECT {_EVENT_OUT} FROM tgt, mark WHERE day <> d
    UNION ALL SELECT {_EVENT_OUT} FROM ({_EVENT_SOURCE}) s, mark WHERE day >= d""",
)
def _append(t):
    return loads.append_from_last_day(event_target(t), event_source(t), "day")


@query(
    "capture_watermark",
    f"WITH ht AS ({_HEADER_TARGET}), {_MARK} SELECT CAST(d AS VARCHAR) AS day, CAST(s AS INTEGER) AS second, k AS key FROM mark",
)
def _capture(t):
    return loads.mark_row(header_target(t)).withColumn("day", F.col("day").cast("date"))


@query(
    "merge_upsert",
    """
    SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name,
           CASE WHEN n.c_custkey IS NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal, o.notes,
           CASE WHEN n.c_custkey IS NULL THEN o._updated_at ELSE '2026-01-01 00:00:00' END AS _updated_at
    FROM (SELECT c_custkey, c_name, c_acctbal, c_mktsegment AS notes, '2020-01-01 00:00:00' AS _updated_at
          FROM customer) o
    FULL JOIN (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 1000000000 END AS c_custkey, upper(c_name) AS c_name,
                      CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal + 1 END AS c_acctbal FROM customer) n ON n.c_custkey = o.c_custkey
    """,
)
def _merge(t):
    target = t.customer.selectExpr(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment AS notes", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS _updated_at"
    )
    src = t.customer.selectExpr(
        "CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE c_custkey + 1000000000 END AS c_custkey", "upper(c_name) AS c_name", "CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal + 1 END AS c_acctbal"
    )
    run_ts = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    return loads.merge_upsert(target, src, ["c_custkey"], "_updated_at", run_ts)


@query(
    "merge_upsert_stored",
    """
    SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, coalesce(n.c_name, o.c_name) AS c_name,
           CASE WHEN n.c_custkey IS NULL THEN o.c_acctbal ELSE n.c_acctbal END AS c_acctbal, o.notes,
           CASE WHEN n.c_custkey IS NULL THEN o._updated_at ELSE '2026-01-01 00:00:00' END AS _updated_at
    FROM (SELECT c_custkey, c_name, c_acctbal, c_mktsegment AS notes, '2020-01-01 00:00:00' AS _updated_at FROM customer) o
    FULL JOIN (SELECT o_custkey AS c_custkey, 'order ' || o_orderkey AS c_name, o_totalprice AS c_acctbal FROM orders
               WHERE o_orderstatus = 'F'
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) n
      ON n.c_custkey = o.c_custkey
    """,
)
def _merge_stored(t):
    """A stored table takes the newest closed order of every customer; a key repeats in the source."""
    store = Store(t.spark, f"{work_folder(t.spark)}/store/{uuid.uuid4().hex}")
    change = store.change()
    target = t.customer.selectExpr(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment AS notes", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS _updated_at"
    )
    change.create("customer", target, ["c_custkey"])
    change.commit()
    src = t.orders.where("o_orderstatus = 'F'").selectExpr(
        "o_custkey AS c_custkey", "'order ' || CAST(o_orderkey AS STRING) AS c_name", "o_totalprice AS c_acctbal", "o_orderdate", "o_orderkey"
    )
    change = store.change()
    change.merge("customer", src, ["o_orderdate", "o_orderkey"], "_updated_at", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    return store.read("customer", change.commit())


@query(
    "check_idempotent_counts",
    """
    SELECT b.table_name, b.n AS after_round1, a.n AS after_round2, a.n - b.n AS delta
    FROM (SELECT 'lines' AS table_name, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
          UNION ALL SELECT 'events', count(*) FROM events) b
    JOIN (SELECT 'lines' AS table_name, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-07-01'
          UNION ALL SELECT 'orders', count(*) FROM orders
          UNION ALL SELECT 'events', count(*) + count(*) FILTER (event_type = 'error') FROM events) a USING (table_name)
    """,
)
def _idempotent(t):
    before = loads.row_counts({"lines": t.lineitem, "orders": t.orders, "events": t.events})
    doubled = t.events.unionByName(t.events.where("event_type = 'error'"))
    older = t.lineitem.where("l_shipdate < TIMESTAMP_NTZ '2001-07-01 00:00:00'")
    after = loads.row_counts({"lines": older, "orders": t.orders, "events": doubled})
    return loads.compare_counts(before, after)


_DUPLICATES = """
    SELECT 'lineitem' AS table_name, count(*) AS dups FROM (
        SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'orders', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
    UNION ALL SELECT 'events', count(*) FROM (SELECT 1 FROM events GROUP BY user_id, ts HAVING count(*) > 1)
    """


def _key_tables(t):
    return {
        "lineitem": (t.lineitem, ["l_orderkey", "l_linenumber"]),
        "orders": (t.orders, ["o_orderkey"]),
        "events": (t.events, ["user_id", "ts"]),
    }


@query("check_duplicate_pk", _DUPLICATES)
def _duplicates(t):
    return loads.duplicate_keys(_key_tables(t))


@query("union_check_results", _DUPLICATES)
def _union_checks(t):
    return loads.duplicate_keys(_key_tables(t))


@query(
    "order_by_abs_delta",
    """
    SELECT p.l_returnflag AS table_name, p.n AS after_round1, q.n AS after_round2, q.n - p.n AS delta
    FROM (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1) p
    JOIN (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' GROUP BY 1) q
      USING (l_returnflag)
    """,
)
def _abs_delta(t):
    cut = "TIMESTAMP_NTZ '1998-01-01 00:00:00'"
    count = lambda where: t.lineitem.where(where).groupBy(F.col("l_returnflag").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return loads.compare_counts(count(f"l_shipdate < {cut}"), count(f"l_shipdate >= {cut}"))


# ---- sheets --------------------------------------------------------------------

_SHEET = (
    "CAST(event_id AS STRING) AS `Order`", "CAST(ts AS STRING) AS `When`", "CAST(value AS STRING) AS `Goal`",
    "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS `Flag`",
    "CASE WHEN event_id % 3 = 0 THEN 'TRUE' END AS `Gappy flag`",
    "CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS STRING) END AS `Gappy number`",
    "CASE WHEN event_id % 7 = 0 THEN 'NaN' ELSE CAST(value AS STRING) END AS `Noisy`",
    "props AS `Text`", "CAST(NULL AS STRING) AS `Empty`",
)


def sheet(t):
    return t.events.selectExpr(*_SHEET)


@query(
    "infer_column_types",
    """
    WITH s AS (SELECT CAST(event_id AS VARCHAR) AS c1, CAST(ts AS VARCHAR) AS c2, CAST(value AS VARCHAR) AS c3,
                      event_id, user_id, props FROM events),
    f AS (SELECT count(*) AS n, count(*) FILTER (regexp_full_match(c1, '[+-]?[0-9]+')) AS i1, count(TRY_CAST(c2 AS TIMESTAMP)) AS t2,
                 count(*) FILTER (regexp_full_match(c3, '[+-]?[0-9]+')) AS i3, count(TRY_CAST(c3 AS DOUBLE)) AS d3,
                 count(TRY_CAST(props AS DOUBLE)) AS d8, max(length(props)) AS len8 FROM s)
    SELECT 'Order' AS column_name, CASE WHEN i1 = n THEN 'bigint' END AS type FROM f
    UNION ALL SELECT 'When', CASE WHEN t2 = n THEN 'timestamp_ntz' END FROM f
    UNION ALL SELECT 'Goal', CASE WHEN i3 = n THEN 'bigint' WHEN d3 = n THEN 'double' END FROM f
    UNION ALL SELECT 'Flag', 'boolean' UNION ALL SELECT 'Gappy flag', 'string(4000)'
    UNION ALL SELECT 'Gappy number', 'double' UNION ALL SELECT 'Noisy', 'double'
    UNION ALL SELECT 'Text', CASE WHEN d8 < n AND len8 <= 4000 THEN 'string(4000)' ELSE 'string(max)' END FROM f
    UNION ALL SELECT 'Empty', 'string(50)'
    """,
)
def _infer(t):
    return sheets.types_table(sheet(t))


@query(
    "load_sheet_snapshot",
    """
    SELECT event_id AS "Order", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "When", value AS "Goal", event_id % 2 = 0 AS "Flag",
           CASE WHEN event_id % 3 = 0 THEN 'TRUE' END AS "Gappy flag",
           CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS DOUBLE) END AS "Gappy number",
           CASE WHEN event_id % 7 <> 0 THEN value END AS "Noisy", props AS "Text", CAST(NULL AS VARCHAR) AS "Empty",
           '2026-01-01 06:00:00' AS _ingested_at
    FROM events
    """,
)
def _snapshot(t):
    """The sheet is exported as CSV and read from there."""
    path = f"{work_folder(t.spark)}/sheets/{uuid.uuid4().hex}"
    sheets.write_export(sheet(t), path)
    return sheets.load_sheet(t.spark, path, F.lit("2026-01-01 06:00:00"))[0]


@query(
    "nan_to_null",
    "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events",
)
def _nan(t):
    noisy = F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return sheets.nan_to_null(t.events.select("event_id", noisy.alias("value")))


@query("stamp_ingested_at", "SELECT o_orderkey, '2026-01-01 06:00:00' AS _ingested_at FROM orders")
def _stamp(t):
    return stamp_ingested_at(t.orders.select("o_orderkey"), F.lit("2026-01-01 06:00:00"))


@query(
    "sink_materialize",
    """
    SELECT store_code, coalesce(new_store_name, old_store_name) AS store_name, count(d.doc_entry) AS documents
    FROM m_standardized_store LEFT JOIN m_sales_invoice_documents d USING (store_code) GROUP BY ALL
    """,
)
def _sink(t):
    """The view layer: later plans read the store dimension by name."""
    stores = sinks.as_view(t.w.model("dim_store"), "ledgerflow_dim_store")
    documents = t.w.model("sales_invoice_documents", "doc_entry", "store_code")
    return stores.join(documents, "store_code", "left").groupBy("store_code", "store_name").agg(
        F.count("doc_entry").alias("documents")
    )


# ---- audit -----------------------------------------------------------------------

NOW = dt.datetime(2024, 1, 31, 1, 30)
_NOW = "TIMESTAMP '2024-01-31 01:30:00'"
_STATUS = "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'interrupted' ELSE 'running' END"
_LOG_COLUMNS = (
    "event_id AS id", "'run-' || CAST(CAST(ts AS DATE) AS STRING) AS execution_id",
    "'table_' || CAST(user_id AS STRING) AS table_name", "'full_reload' AS strategy", "ts AS started_at",
    f"{_STATUS} AS status",
    f"CASE WHEN {_STATUS} <> 'running' THEN ts + INTERVAL 7 MINUTES END AS finished_at",
    f"CASE WHEN {_STATUS} = 'success' THEN event_id * 10 END AS row_count",
    f"CASE WHEN {_STATUS} = 'error' THEN props END AS error_message",
)
_LOG = "SELECT " + ", ".join(_LOG_COLUMNS).replace("INTERVAL 7 MINUTES", "INTERVAL 7 MINUTE") + " FROM events"
_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}"
_LOG_OUT = (
    f"id, execution_id, table_name, strategy, {_TIME.format('started_at')}, status, "
    f"{_TIME.format('finished_at')}, row_count, error_message"
)


def event_log(t):
    return t.events.selectExpr(*_LOG_COLUMNS)


@query(
    "audit_status_fold",
    f"""
    WITH e AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS execution_id, 'table_' || user_id AS table_name, ts, event_id,
                      CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' ELSE 'running' END AS st, props
               FROM events),
    l AS (SELECT *, min(ts) OVER (PARTITION BY execution_id, table_name) AS s FROM e
          QUALIFY row_number() OVER (PARTITION BY execution_id, table_name ORDER BY ts DESC, event_id DESC) = 1)
    SELECT execution_id, table_name, strftime(s, '%Y-%m-%d %H:%M:%S') AS started_at,
           CASE WHEN st <> 'running' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS finished_at, st AS status,
           CASE WHEN st = 'success' THEN event_id * 10 END AS row_count,
           CASE WHEN st = 'error' THEN repeat(props, 500) END AS error_message
    FROM l
    """,
)
def _fold(t):
    events = t.events.selectExpr(
        "CAST(CAST(ts AS DATE) AS STRING) AS execution_id", "'table_' || CAST(user_id AS STRING) AS table_name",
        "ts AS at", "event_id", "event_id * 10 AS row_count", "props AS message",
        "CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'success' ELSE 'running' END AS status",
    )
    # the text is written out for the loads that show it, as in the check SQL, not for every event that is folded
    return audit.fold_status(events).withColumn("error_message", F.expr("repeat(error_message, 500)"))


@query(
    "audit_self_heal",
    f"""
    WITH l AS ({_LOG}), st AS (SELECT 'table_' || user_id AS table_name, max(ts) + INTERVAL 1 HOUR AS new_start
                               FROM events WHERE user_id % 3 = 0 GROUP BY 1)
    SELECT id, execution_id, l.table_name, strategy, {_TIME.format('started_at')},
           CASE WHEN st.new_start IS NOT NULL AND status = 'running' THEN 'interrupted' ELSE status END AS status,
           strftime(CASE WHEN status = 'running' AND st.new_start IS NOT NULL THEN st.new_start ELSE finished_at END, '%Y-%m-%d %H:%M:%S') AS finished_at,
           row_count,
           CASE WHEN status = 'running' AND st.new_start IS NOT NULL THEN '{audit.HEALED}' ELSE error_message END AS error_message
    FROM l LEFT JOIN st USING (table_name)
    """,
)
def _heal(t):
    starts = (
        t.events.where("user_id % 3 = 0")
        .groupBy(F.expr("'table_' || CAST(user_id AS STRING)").alias("table_name"))
        .agg(F.max("ts").alias("last"))
        .selectExpr("table_name", "last + INTERVAL 1 HOUR AS new_start")
    )
    return audit.self_heal(event_log(t), starts)


@query(
    "audit_cleanup_orphans",
    f"""
    WITH l AS (SELECT *, status = 'running' AND date_diff('minute', started_at, {_NOW}) > 60 AS stuck FROM ({_LOG}))
    SELECT {_LOG_OUT} FROM (
        SELECT * REPLACE (CASE WHEN stuck THEN 'interrupted' ELSE status END AS status,
                          CASE WHEN stuck THEN {_NOW} ELSE finished_at END AS finished_at,
                          CASE WHEN stuck THEN '{audit.ORPHANED}' ELSE error_message END AS error_message) FROM l)
    """,
)
def _orphans(t):
    return audit.cleanup_orphans(event_log(t), NOW)


_LATEST = f"(SELECT * FROM ({_LOG}) QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY started_at DESC, id DESC) = 1)"


@query("latest_audit_row", f"SELECT {_LOG_OUT} FROM {_LATEST}")
def _latest(t):
    return audit.latest_loads(event_log(t))


@query(
    "audit_issues",
    f"""
    SELECT {_LOG_OUT}, CASE status WHEN 'running' THEN 'stuck' ELSE status END AS diagnosis,
           date_diff('minute', started_at, coalesce(finished_at, {_NOW})) AS elapsed_min
    FROM {_LATEST}
    WHERE status IN ('error', 'interrupted') OR (status = 'running' AND date_diff('minute', started_at, {_NOW}) > 60)
    """,
)
def _issues(t):
    return audit.issues(event_log(t), NOW)


_JOB = (
    "CASE user_id % 4 WHEN 0 THEN 'other_' ELSE 'ingestion_' END || CAST(user_id AS STRING) AS job",
    "CAST(event_id % 3 AS INT) AS step_id", "CAST(event_id % 6 AS INT) AS run_status",
    "year(ts) * 10000 + month(ts) * 100 + day(ts) AS run_date",
    "hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS run_time",
    "CAST(event_id % 240 AS INT) AS run_duration", "event_id AS instance_id", "props AS message",
)


@query(
    "job_latest_run",
    f"""
    SELECT 'ingestion_' || user_id AS job,
           CASE event_id % 6 WHEN 0 THEN 'failed' WHEN 1 THEN 'success' WHEN 2 THEN 'retry' WHEN 3 THEN 'canceled'
                             WHEN 4 THEN 'running' ELSE '?' END AS result,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS last_run, date_diff('minute', ts, {_NOW}) AS min_since,
           CAST(event_id % 240 AS INTEGER) AS duration_hhmmss, props AS message
    FROM events WHERE user_id % 4 <> 0 AND event_id % 3 = 0
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts) DESC, event_id DESC) = 1
    """,
)
def _jobs(t):
    return audit.job_latest_run(t.events.selectExpr(*_JOB), NOW)


@query(
    "audit_round_summary",
    f"""
    SELECT count(*) AS tables, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'error') AS error,
           count(*) FILTER (status = 'running') AS running, CAST(sum(row_count) AS BIGINT) AS total_rows,
           date_diff('second', min(started_at), max(coalesce(finished_at, {_NOW}))) AS total_sec
    FROM ({_LOG}) WHERE started_at >= TIMESTAMP '2024-01-10'
    """,
)
def _summary(t):
    log = event_log(t).where("started_at >= TIMESTAMP_NTZ '2024-01-10 00:00:00'")
    return audit.round_summary(log, NOW)
