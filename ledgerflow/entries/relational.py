"""Registered joins, aggregations, window operators, unions, quality checks and streams."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.contract import column_type
from ledgerflow.entries.base import DRIVER_PARAMS, query
from ledgerflow.entries.model_sql import day, fold
from ledgerflow.functions import predicates, text
from ledgerflow.functions.measures import guarded_ratio, total
from ledgerflow.operators import quality
from ledgerflow.operators.as_of import as_of_join, overlap_offenders
from ledgerflow.operators.joins import (
    code_or_name, lookup, match_key, overlapping_periods, temporal_left_join,
)
from ledgerflow.operators.latest import first_per_key, latest_per_key
from ledgerflow.operators.setops import union_bricks, union_labelled
from ledgerflow.operators.skew import anti_join, join_lines_to_headers, semi_join
from ledgerflow.plans.catalogue import CATALOGUE, catalogue_results, tested_in_turn
from ledgerflow.plans.common import goal_rows
from ledgerflow.plans.marts import days_between, outflow_windows
from ledgerflow.plans.sales import GOAL_KEY, goals_with_store
from ledgerflow.session import work_folder
from ledgerflow.sources import loads
from ledgerflow.streaming.daily_close import closed_day_flow
from ledgerflow.streaming.upsert_latest import newest_of

AS_OF = DRIVER_PARAMS.as_of

# ---- joins ---------------------------------------------------------------------------


@query(
    "join_lookup_left",
    """SELECT o.o_orderkey, c.c_name, n.n_name AS nation, r.r_name AS region FROM orders o
       LEFT JOIN customer c ON c.c_custkey = o.o_custkey LEFT JOIN nation n ON n.n_nationkey = CASE WHEN c.c_nationkey = 4 THEN 99 ELSE c.c_nationkey END
       LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
)
def _lookup(t):
    df = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    df = lookup(df, t.customer, {"c_custkey": "c_custkey"}, {"c_name": F.col("c_name"), "nk": F.expr("CASE WHEN c_nationkey = 4 THEN 99 ELSE c_nationkey END")})
    df = lookup(df, t.nation, {"nk": "n_nationkey"}, {"nation": F.col("n_name"), "rk": F.col("n_regionkey")})
    df = lookup(df, t.region, {"rk": "r_regionkey"}, {"region": F.col("r_name")})
    return df.select("o_orderkey", "c_name", "nation", "region")


@query(
    "join_lines_headers",
    """SELECT l.document_type, l.doc_entry, CAST(l.line_number AS VARCHAR) AS line_number, d.document_number, CAST(l.line_total AS DOUBLE) AS line_total
       FROM m_sales_fiscal_lines l JOIN m_sales_fiscal_documents d
         ON l.document_type = d.document_type AND l.doc_entry = d.doc_entry""",
)
def _lines_headers(t):
    keys = ["document_type", "doc_entry"]
    lines = t.w.model("sales_fiscal_lines", *keys, "line_number", "line_total")
    headers = t.w.model("sales_fiscal_documents", *keys, "document_number")
    return join_lines_to_headers(lines, headers, keys)


@query(
    "join_composite_left",
    """SELECT l.DocEntry AS doc_entry, CAST(l.LineNum AS VARCHAR) AS line_number, CAST(p.bdi_price AS DOUBLE) AS bdi_price, p.line_key, u.main_usage_id
       FROM raw_inv1 l LEFT JOIN m_sales_prices_invoice p ON p.doc_entry = l.DocEntry AND p.line_number = l.LineNum
       LEFT JOIN m_sales_fiscal_usage_invoice u ON u.doc_entry = l.DocEntry""",
)
def _composite(t):
    lines = t.w.stage("sales_invoice_lines_inv1").select("doc_entry", "line_number")
    prices = t.w.model("sales_prices_invoice", "doc_entry", "line_number", "line_key", "bdi_price")
    usage = t.w.model("sales_fiscal_usage_invoice", "doc_entry", "main_usage_id")
    return lines.join(prices, ["doc_entry", "line_number"], "left").join(usage, "doc_entry", "left")


@query(
    "join_role_playing",
    """SELECT j.TransId AS transaction_id, j.Line_ID AS line_number, strftime(j._ingested_at, '%Y-%m-%d %H:%M:%S') AS _ingested_at,
              lower(a.AcctName) AS account_name, lower(o.AcctName) AS offset_account_name
       FROM raw_jdt1 j LEFT JOIN raw_oact a ON a.AcctCode = j.Account LEFT JOIN raw_oact o ON o.AcctCode = j.ContraAct""",
)
def _roles(t):
    lines = t.w.stage("journal_entry_lines_jdt1")
    accounts = t.w.stage("chart_of_accounts_oact")
    for key, label in (("ledger_account", "account_name"), ("offset_account", "offset_account_name")):
        lines = lookup(lines, accounts, {key: "account_code"}, {label: F.lower("account_name")})
    return lines.select("transaction_id", "line_number", "_ingested_at", "account_name", "offset_account_name")


_RESOLVER = "(SELECT Code AS entry, Code AS resolved FROM raw_stores UNION ALL SELECT Name, Code FROM raw_stores)"


@query(
    "join_code_or_name",
    f"""SELECT o.DocEntry AS doc_entry, o.U_Store AS entry, s.resolved, strftime(o._ingested_at, '%Y-%m-%d %H:%M:%S') AS _ingested_at
        FROM raw_oinv o LEFT JOIN {_RESOLVER} s ON s.entry = o.U_Store""",
)
def _code_or_name(t):
    docs = t.w.stage("sales_invoice_oinv").select("doc_entry", F.col("store_code").alias("entry"), "_ingested_at")
    return docs.join(code_or_name(t.w.stage("store"), "store_code", "store_name"), "entry", "left")


@query("union_resolver", f"SELECT entry, resolved FROM {_RESOLVER}")
def _resolver(t):
    return code_or_name(t.w.stage("store"), "store_code", "store_name")


@query(
    "join_constant_qualified",
    """SELECT d.doc_entry, CAST(coalesce(f.freight_amount, 0) AS DOUBLE) AS freight_amount FROM m_sales_return_documents d
       LEFT JOIN m_sales_freight_document f ON f.document_type = 'return' AND f.doc_entry = d.doc_entry""",
)
def _constant(t):
    docs = t.w.model("sales_return_documents", "doc_entry")
    freight = t.w.model("sales_freight_document").where(F.col("document_type") == "return").drop("document_type")
    return docs.join(freight, "doc_entry", "left").fillna(0, ["freight_amount"])


_PERIODS = """(SELECT user_id, version, day_from, lead(day_from) OVER (PARTITION BY user_id ORDER BY day_from) - 1 AS day_to
               FROM (SELECT user_id, CAST(ts AS DATE) AS day_from, max(event_id) AS version FROM events
                     WHERE event_type IN ('signup', 'purchase') GROUP BY 1, 2))"""


def event_periods(t):
    """Validity periods between a user's days of change; the last one is open.

    Changes are reduced to one row per user and day first, so the window of a
    user is never longer than the calendar.
    """
    changes = t.events.where("event_type IN ('signup', 'purchase')")
    per_day = changes.groupBy("user_id", F.col("ts").cast("date").alias("day_from")).agg(F.max("event_id").alias("version"))
    following = F.lead("day_from").over(Window.partitionBy("user_id").orderBy("day_from"))
    return per_day.withColumn("day_to", F.date_sub(following, 1))


@query(
    "join_temporal_range",
    f"""SELECT e.event_id, e.name, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS day, p.version FROM
        (SELECT *, 'Usuário ' || user_id AS name FROM events WHERE event_type = 'error') e
        LEFT JOIN {_PERIODS} p ON p.user_id = e.user_id AND CAST(e.ts AS DATE) BETWEEN p.day_from AND coalesce(p.day_to, DATE '9999-12-31')""",
)
def _temporal(t):
    """Errors with the period that covers their day; names match without case and accents."""
    user = F.col("user_id").cast("string")
    errors = t.events.where("event_type = 'error'").select(
        "event_id", F.concat(F.lit("Usuário "), user).alias("name"), F.col("ts").cast("date").alias("day")
    )
    periods = event_periods(t).withColumn("name", F.concat(F.lit("USUARIO "), user)).drop("user_id")
    joined = as_of_join(errors, periods, "name", "day", "day_from", "day_to", {"version": "version"})
    return joined.select("event_id", "name", "day", "version")


@query(
    "join_interval_overlap",
    f"""WITH p AS (SELECT user_id, version, day_from, CASE WHEN version % 5 = 0 THEN day_to + 3 ELSE day_to END AS day_to FROM {_PERIODS})
        SELECT a.user_id, CAST(a.day_from AS VARCHAR) AS start_a, CAST(a.day_to AS VARCHAR) AS end_a,
               CAST(b.day_from AS VARCHAR) AS start_b, CAST(b.day_to AS VARCHAR) AS end_b
        FROM p a JOIN p b ON a.user_id = b.user_id AND a.day_from < b.day_from
         AND a.day_from <= coalesce(b.day_to, DATE '9999-12-31') AND b.day_from <= coalesce(a.day_to, DATE '9999-12-31')""",
)
def _overlap(t):
    """Every fifth period was closed three days late."""
    late = F.when(F.col("version") % 5 == 0, F.date_add("day_to", 3)).otherwise(F.col("day_to"))
    periods = event_periods(t).withColumn("day_to", late)
    return overlapping_periods(periods, ["user_id"], "day_from", "day_to", width_days=7)


@query(
    "join_ci_ai",
    f"""SELECT e.employee_code, e.employee_name, g.first_goal FROM m_employee e
        JOIN (SELECT normalized_name, CAST(first_goal AS VARCHAR) AS first_goal FROM m_goal_name_entry) g
          ON {fold('g.normalized_name')} = {fold('e.employee_name')}""",
)
def _ci_ai(t):
    goals = t.w.model("goal_name_entry").select(match_key(F.col("normalized_name")).alias("k"), "first_goal")
    people = t.w.model("employee", "employee_code", "employee_name").withColumn("k", match_key(F.col("employee_name")))
    return people.join(goals, "k").drop("k")


@query(
    "join_remapped_key",
    """SELECT g.loja AS store_text, s.store_code, count(*) AS goals
       FROM (SELECT "Loja" AS loja, lower(trim("Loja")) AS k FROM m_goal_rows) g
       LEFT JOIN m_standardized_store s ON s.old_store_name = CASE k WHEN 'bonsucesso - rj' THEN 'bonsucesso' ELSE k END
       GROUP BY ALL""",
)
def _remapped(t):
    goals = goal_rows(t.w).select(F.col("store").alias("store_text"), text.goal_store_key(F.col("store")).alias("k"))
    stores = t.w.model("standardized_store").select(F.col("old_store_name").alias("k"), "store_code")
    return goals.join(stores, "k", "left").groupBy("store_text", "store_code").agg(F.count(F.lit(1)).alias("goals"))


@query(
    "anti_join_not_exists",
    """SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS
       (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F' AND o.o_totalprice > 200000)""",
)
def _anti(t):
    big = t.orders.where("o_orderstatus = 'F' AND o_totalprice > 200000D").select(F.col("o_custkey").alias("c_custkey"))
    return anti_join(t.customer.select("c_custkey", "c_name"), big, ["c_custkey"])


@query(
    "semi_join_exists_inequality",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE EXISTS
       (SELECT 1 FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_suppkey <> l.l_suppkey)""",
)
def _semi_inequality(t):
    """Lines of an order that also has another supplier: the order's supplier range decides.

    Another supplier exists exactly where the smallest or the largest one
    differs, so no pairs of lines are compared.
    """
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    span = lines.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("low"), F.max("l_suppkey").alias("high"))
    several = span.where("low <> high").select("l_orderkey")
    return semi_join(lines, several, ["l_orderkey"])


@query(
    "semi_join_in_subquery",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01')",
)
def _semi(t):
    recent = t.orders.where("o_orderdate > TIMESTAMP_NTZ '2001-01-01 00:00:00'").select(F.col("o_orderkey").alias("l_orderkey"))
    return semi_join(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), recent, ["l_orderkey"])


@query(
    "cross_join_tally",
    """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date, count(o_orderkey) AS orders
       FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders))
       LEFT JOIN orders ON o_orderdate = d GROUP BY 1""",
)
def _tally(t):
    """Number table from a sequence instead of repeated cross joins: orders per calendar day."""
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    per_day = days.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))
    return days_between(days, "date", "date").join(per_day, "date", "left").fillna(0, ["orders"])


@query(
    "row_number_constant_order",
    """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date, CAST(row_number() OVER (ORDER BY d) - 1 AS INTEGER) AS n
       FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem))""",
)
def _numbers(t):
    """Numbered days of the shipping span, with the position taken from the sequence itself."""
    span = t.lineitem.agg(F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi"))
    return span.select(F.posexplode(F.sequence("lo", "hi")).alias("n", "date"))


@query(
    "join_parameterized",
    f"""SELECT s.item_code, s.warehouse_code, CAST(p.list_price AS DOUBLE) AS list_price FROM m_current_inventory s
        LEFT JOIN m_item_price_list p ON p.item_code = s.item_code AND p.price_list_number = {DRIVER_PARAMS.price_list}""",
)
def _parameterized(t):
    prices = t.w.model("item_price_list", "item_code", "price_list_number", "list_price")
    prices = prices.where(F.col("price_list_number") == t.w.params.price_list).drop("price_list_number")
    return t.w.model("current_inventory", "item_code", "warehouse_code").join(prices, "item_code", "left")


@query(
    "join_inner_master",
    """SELECT ItemCode AS item_code, WhsCode AS warehouse_code, CAST(OnHand AS DOUBLE) AS inventory_quantity FROM raw_oitw
       WHERE WhsCode IN (SELECT WhsCode FROM raw_owhs) AND ItemCode IN (SELECT ItemCode FROM raw_oitm)""",
)
def _inner(t):
    return t.w.model("current_inventory", "item_code", "warehouse_code", "inventory_quantity")


@query(
    "join_branches_aggregates",
    """SELECT o.o_custkey, o.n AS orders, l.n AS lines FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o
       JOIN (SELECT o_custkey, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) l USING (o_custkey)""",
)
def _aggregates(t):
    """Two aggregates of different grain meet on their key; lines are counted per order first."""
    headers = t.orders.select("o_orderkey", "o_custkey")
    per_customer = headers.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    per_order = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    lines = headers.join(per_order, "o_orderkey").groupBy("o_custkey").agg(F.sum("n").alias("lines"))
    return per_customer.join(lines, "o_custkey")


@query(
    "delete_join",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')",
)
def _delete(t):
    gone = t.customer.where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return anti_join(t.orders.select("o_orderkey", "o_totalprice", "o_custkey"), gone, ["o_custkey"]).drop("o_custkey")


# ---- aggregations ------------------------------------------------------------------


@query(
    "agg_basic",
    """SELECT DocEntry AS doc_entry, CAST(sum(InsTotal) AS DOUBLE) AS total, count(*) AS installments,
              CAST(CAST(min(DueDate) AS DATE) AS VARCHAR) AS first_due, CAST(CAST(max(DueDate) AS DATE) AS VARCHAR) AS last_due
       FROM raw_inv6 GROUP BY 1""",
)
def _basic(t):
    return t.w.stage("sales_invoice_installments_inv6").groupBy("doc_entry").agg(
        total(F.sum("installment_amount")).alias("total"), F.count(F.lit(1)).alias("installments"),
        F.min("due_date").alias("first_due"), F.max("due_date").alias("last_due"),
    )


@query(
    "agg_conditional",
    """SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS returned, count(*) FILTER (l_tax > 0.05) AS high_tax,
              CAST(sum(l_quantity) FILTER (l_returnflag <> 'R') AS DOUBLE) AS kept_quantity
       FROM lineitem GROUP BY 1""",
)
def _conditional(t):
    flag = F.col("l_returnflag")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(flag == "R", 1).otherwise(0)).alias("returned"),
        F.sum(F.when(F.col("l_tax") > 0.05, 1).otherwise(0)).alias("high_tax"),
        F.sum(F.when(flag != "R", F.col("l_quantity")).otherwise(0)).alias("kept_quantity"),
    )


_OUT = {"30d": f"{day(AS_OF)} - 30", "45d": f"{day(AS_OF)} - 45", "60d": f"{day(AS_OF)} - 60", "ytd": f"DATE '{AS_OF.year}-01-01'"}


@query(
    "agg_rolling_calendar_windows",
    "SELECT ItemCode AS item_code, " + ", ".join(
        f"CAST(sum(CASE WHEN DocDate >= {since} THEN OutQty ELSE 0 END) AS DOUBLE) AS outflow_quantity_{k}" for k, since in _OUT.items()
    ) + f", CAST(CAST(max(CASE WHEN OutQty > 0 THEN DocDate END) AS DATE) AS VARCHAR) AS last_outflow_date FROM raw_oinm WHERE DocDate < {day(AS_OF)} GROUP BY 1",
)
def _windows(t):
    return outflow_windows(t.w.stage("inventory_movement_oinm"), ["item_code"], AS_OF)


@query(
    "agg_last_event_date",
    """SELECT ItemCode AS item_code, Warehouse AS warehouse_code, CAST(CAST(max(DocDate) FILTER (OutQty > 0) AS DATE) AS VARCHAR) AS last_outflow_date
       FROM raw_oinm GROUP BY 1, 2""",
)
def _last_event(t):
    return t.w.stage("inventory_movement_oinm").groupBy("item_code", "warehouse_code").agg(
        F.max(F.when(F.col("outflow_quantity") > 0, F.col("movement_date"))).alias("last_outflow_date")
    )


@query(
    "select_distinct",
    """SELECT DISTINCT o_orderkey, o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
)
def _distinct(t):
    """Headers with a qualifying line: a semi-join leaves each header once."""
    returned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return semi_join(t.orders.select("o_orderkey", "o_custkey"), returned, ["o_orderkey"])


@query(
    "agg_min_per_name",
    """SELECT strip_accents(lower(rtrim(string_split(trim("Vendedor"), ' - ')[1]))) AS name, CAST(CAST(min("Data") AS DATE) AS VARCHAR) AS first_goal
       FROM m_goal_rows GROUP BY 1""",
)
def _min_per_name(t):
    name = match_key(text.normalized_name(F.col("salesperson")))
    return goal_rows(t.w).groupBy(name.alias("name")).agg(F.min("date").alias("first_goal"))


@query(
    "agg_scalar_max",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderdate > (SELECT coalesce(max(o_orderdate), DATE '1900-01-01') FROM orders WHERE o_orderstatus = 'F') - INTERVAL 30 DAY",
)
def _scalar_max(t):
    """Rows after the high mark of another set, less 30 days, through a scalar subquery."""
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus")
    mark = days.where("o_orderstatus = 'F'").agg(F.coalesce(F.max("day"), F.lit(dt.date(1900, 1, 1)))).scalar()
    return days.where(F.col("day") > F.date_sub(mark, 30)).select("o_orderkey", "day")


@query(
    "agg_having",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def _having(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


@query(
    "agg_freight",
    """SELECT document_type, DocEntry AS doc_entry, CAST(sum(LineTotal) AS DOUBLE) AS freight_amount
       FROM (SELECT 'invoice' AS document_type, * FROM raw_inv3 UNION ALL SELECT 'return', * FROM raw_rin3) WHERE ExpnsCode = 1 GROUP BY 1, 2""",
)
def _freight(t):
    return t.w.model("sales_freight_document")


# ---- windows and top-k ------------------------------------------------------------------


@query(
    "latest_per_key",
    """SELECT DocEntry AS doc_entry, CAST(DocTotal AS DOUBLE) AS document_total, strftime(_ingested_at, '%Y-%m-%d %H:%M:%S') AS _ingested_at
       FROM raw_oinv QUALIFY row_number() OVER (PARTITION BY DocEntry ORDER BY _ingested_at DESC) = 1""",
)
def _latest(t):
    rows = t.w.stage("sales_invoice_oinv").select("doc_entry", "document_total", "_ingested_at")
    return latest_per_key(rows, ["doc_entry"], "_ingested_at", "document_total")


@query(
    "dedup_goals",
    """SELECT channel, CAST(CAST("Data" AS DATE) AS VARCHAR) AS date, "Vendedor" AS salesperson, "Loja" AS store,
              CAST("Meta Diária" AS DOUBLE) AS daily_goal FROM m_goal_rows
       QUALIFY row_number() OVER (PARTITION BY channel, "Data", "Vendedor", "Loja" ORDER BY _ingested_at DESC, "Ordem Vendedor" DESC) = 1""",
)
def _dedup(t):
    keys = ["channel", "date", "salesperson", "store"]
    return latest_per_key(goal_rows(t.w), keys, "_ingested_at", "salesperson_order").select(*keys, "daily_goal")


@query(
    "end_of_day_state",
    """SELECT ItemCode AS item_code, Warehouse AS warehouse_code, CAST(CAST(DocDate AS DATE) AS VARCHAR) AS movement_date,
              CAST(TransNum AS VARCHAR) AS transaction_number, CAST(Balance AS DOUBLE) AS balance FROM raw_oinm
       QUALIFY row_number() OVER (PARTITION BY ItemCode, Warehouse, CAST(DocDate AS DATE) ORDER BY TransNum DESC) = 1""",
)
def _end_of_day(t):
    keys = ["item_code", "warehouse_code", "movement_date"]
    balance = F.max_by("inventory_value_after_movement", "transaction_number").alias("balance")
    return t.w.stage("inventory_movement_oinm").groupBy(*keys).agg(F.max("transaction_number").alias("transaction_number"), balance)


@query(
    "priority_tiebreak",
    """SELECT channel, CAST(date AS VARCHAR) AS date, original_goal_salesperson, original_goal_store, salesperson_code, goal_store_code
       FROM m_sales_goals""",
)
def _priority(t):
    versions = t.w.model("salesperson_bridge").select(
        "normalized_name", "valid_from", "valid_to", "salesperson_code", F.col("store_code").alias("version_store")
    )
    matched = temporal_left_join(goals_with_store(t.w), versions, "normalized_name", "date", "valid_from", "valid_to")
    same_store = F.when(F.col("version_store") == F.col("goal_store_code"), 0).otherwise(1)
    best = first_per_key(
        matched, GOAL_KEY, [same_store, F.col("valid_from").desc(), F.col("salesperson_code"), F.col("goal_store_code")]
    )
    return best.select(*GOAL_KEY, "salesperson_code", "goal_store_code")


@query(
    "top1_lexicographic",
    "SELECT CAST(CAST(UpdateDate AS DATE) AS VARCHAR) AS update_date, UpdateTS AS update_ts FROM raw_oinv ORDER BY UpdateDate DESC, UpdateTS DESC LIMIT 1",
)
def _top1(t):
    """Largest (date, second) pair by one aggregate instead of a sort."""
    docs = t.w.stage("sales_invoice_oinv")
    newest = docs.agg(F.max(F.struct("updated_date", "update_ts")).alias("top"))
    return newest.select(F.col("top.updated_date").alias("update_date"), F.col("top.update_ts").alias("update_ts"))


# ---- unions ---------------------------------------------------------------------------------


@query(
    "union_document_bricks",
    """SELECT 'sales' AS side, document_type, count(*) AS lines FROM m_sales_fiscal_lines GROUP BY 2
       UNION ALL SELECT 'purchases', document_type, count(*) FROM m_purchases_fiscal_lines GROUP BY 2""",
)
def _bricks(t):
    sides = {s: t.w.model(f"{s}_fiscal_lines", "document_type") for s in ("sales", "purchases")}
    return union_labelled(sides, "side").groupBy("side", "document_type").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "union_expenses",
    """SELECT 'invoice' AS document_type, DocEntry AS doc_entry, CAST(LineTotal AS DOUBLE) AS expense_amount FROM raw_inv3
       UNION ALL SELECT 'return', DocEntry, CAST(LineTotal AS DOUBLE) FROM raw_rin3""",
)
def _expenses(t):
    return t.w.model("sales_expenses", "document_type", "doc_entry", "expense_amount")


@query(
    "union_goals",
    'SELECT channel, CAST(CAST("Data" AS DATE) AS VARCHAR) AS date, "Vendedor" AS salesperson, "Ordem Vendedor" AS salesperson_order FROM m_goal_rows',
)
def _union_goals(t):
    return goal_rows(t.w).select("channel", "date", "salesperson", "salesperson_order")


# ---- data quality ------------------------------------------------------------------------------


@query("dq_not_null", "SELECT document_type, doc_entry, CAST(line_number AS VARCHAR) AS line_number FROM m_fact_sales WHERE employee_code IS NULL")
def _not_null(t):
    sales = t.w.model("fact_sales", "document_type", "doc_entry", "line_number", "employee_code")
    return quality.not_null(sales, "employee_code").drop("employee_code")


@query("dq_unique", "SELECT DocEntry AS doc_entry, count(*) AS occurrences FROM raw_oinv GROUP BY 1 HAVING count(*) > 1")
def _unique(t):
    return quality.unique_keys(t.w.stage("sales_invoice_oinv"), ["doc_entry"])


@query(
    "dq_unique_combination",
    "SELECT TransId AS transaction_id, Line_ID AS line_number, count(*) AS occurrences FROM raw_jdt1 GROUP BY 1, 2 HAVING count(*) > 1",
)
def _unique_combination(t):
    return quality.unique_keys(t.w.stage("journal_entry_lines_jdt1"), ["transaction_id", "line_number"])


@query(
    "dq_accepted_values",
    "SELECT triangulation, count(*) AS occurrences FROM m_sales_invoice_documents WHERE triangulation NOT IN ('yes', 'no', 'to confirm') GROUP BY 1",
)
def _accepted(t):
    docs = t.w.model("sales_invoice_documents", "triangulation")
    return quality.accepted_values(docs, "triangulation", ["yes", "no", "to confirm"])


@query(
    "dq_relationships",
    """SELECT document_type, doc_entry, CAST(line_number AS VARCHAR) AS line_number, warehouse_code FROM m_fact_sales
       WHERE document_type = 'invoice' AND warehouse_code IS NOT NULL AND warehouse_code NOT IN (SELECT warehouse_code FROM m_dim_warehouse)""",
)
def _relationships(t):
    sales = t.w.model("fact_sales", "document_type", "doc_entry", "line_number", "warehouse_code")
    parent = t.w.model("dim_warehouse", "warehouse_code")
    return quality.relationships(sales, "warehouse_code", parent, "warehouse_code", F.col("document_type") == "invoice")


@query(
    "dq_accepted_range",
    "SELECT document_type, doc_entry, CAST(line_number AS VARCHAR) AS line_number, CAST(gross_profit AS DOUBLE) AS gross_profit FROM m_fact_sales WHERE CAST(gross_profit AS DECIMAL(20,6)) < 0",
)
def _range(t):
    sales = t.w.model("fact_sales", "document_type", "doc_entry", "line_number", "gross_profit")
    return quality.accepted_range(sales, "gross_profit", minimum=0)


_JOURNAL = "m_finance_journal_entries"


@query(
    "dq_double_entry",
    f"""SELECT transaction_id, CAST(CAST(sum(debit) AS DECIMAL(20,2)) AS DOUBLE) AS total_debit,
               CAST(CAST(sum(credit) AS DECIMAL(20,2)) AS DOUBLE) AS total_credit,
               CAST(CAST(sum(debit - credit) AS DECIMAL(20,2)) AS DOUBLE) AS difference
        FROM {_JOURNAL} GROUP BY 1 HAVING abs(sum(debit) - sum(credit)) > 0.01""",
)
def _double_entry(t):
    return quality.double_entry(t.w.model("finance_journal_entries", "transaction_id", "debit", "credit"))


_XOR = ("transaction_id", "line_number", "ledger_account", "debit", "credit")


@query(
    "dq_debit_xor_credit",
    f"SELECT transaction_id, CAST(line_number AS VARCHAR) AS line_number, ledger_account, CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit FROM {_JOURNAL} WHERE least(debit, credit) > 0",
)
def _xor(t):
    return quality.debit_xor_credit(t.w.model("finance_journal_entries", *_XOR))


_STRETCHED = """(SELECT salesperson_code, store_code, valid_from, CASE copy WHEN 0 THEN valid_from + 400 END AS valid_to
    FROM (SELECT salesperson_code, store_code, valid_from + CAST(copy * (300 + salesperson_code * 20) AS INTEGER) AS valid_from, copy
          FROM m_salesperson_bridge, (VALUES (0), (1)) AS c(copy)))"""


def stretched_bridge(t):
    """Two versions per salesperson; for the lower codes the second starts before the first ends."""
    base = t.w.model("salesperson_bridge", "salesperson_code", "store_code", "valid_from")
    first = F.struct(F.col("valid_from"), F.date_add("valid_from", 400).alias("valid_to"))
    later = F.date_add("valid_from", (F.col("salesperson_code") * 20 + 300))
    second = F.struct(later.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    return base.select("salesperson_code", "store_code", F.inline(F.array(first, second)))


@query(
    "dq_no_overlap",
    f"""SELECT a.salesperson_code, a.store_code, CAST(a.valid_from AS VARCHAR) AS start_a, CAST(a.valid_to AS VARCHAR) AS end_a,
               CAST(b.valid_from AS VARCHAR) AS start_b, CAST(b.valid_to AS VARCHAR) AS end_b
        FROM {_STRETCHED} a JOIN {_STRETCHED} b USING (salesperson_code, store_code)
        WHERE a.valid_from < b.valid_from AND b.valid_from <= coalesce(a.valid_to, DATE '9999-12-31')
          AND a.valid_from <= coalesce(b.valid_to, DATE '9999-12-31')
        QUALIFY row_number() OVER (PARTITION BY salesperson_code, store_code, b.valid_from, b.valid_to
                                   ORDER BY coalesce(a.valid_to, DATE '9999-12-31') DESC, a.valid_from DESC) = 1""",
)
def _no_overlap(t):
    """One row per version that starts while an earlier one lasts, with the earlier one that lasts longest."""
    return overlap_offenders(stretched_bridge(t), ["salesperson_code", "store_code"], "valid_from", "valid_to")


@query(
    "dq_single_open_version",
    f"""SELECT user_id, count(*) AS open_versions FROM {_PERIODS} WHERE day_to IS NULL OR version % 7 = 0 GROUP BY 1 HAVING count(*) > 1""",
)
def _single_open(t):
    """Every seventh period was left open."""
    versions = event_periods(t).withColumn("valid_to", F.when(F.col("version") % 7 != 0, F.col("day_to")))
    return quality.single_open_version(versions, ["user_id"])


def _declared_sql(model: str) -> str:
    """Plain SQL of a model's declared tests, one SELECT each."""
    declared = CATALOGUE[model]

    def text(column: str, kind: str | None = None) -> str:
        kind = kind or column_type(model, column)
        return f"CAST(CAST({column} AS DATE) AS VARCHAR)" if kind == "date" else f"CAST({column} AS VARCHAR)"

    def literal(value) -> str:
        return f"DATE '{value}'" if isinstance(value, dt.date) else repr(value)

    key = f"concat_ws(chr(31), {', '.join(f'coalesce({text(c)}, chr(30))' for c in declared.key)})"
    parts = []
    for test, severity, column in declared.tests(model):
        kind = test.partition(":")[0]
        if kind == "unique":
            known = f"WHERE {declared.key[0]} IS NOT NULL" if len(declared.key) == 1 else ""
            source, sample = f"(SELECT {key} AS k FROM m_{model} {known} GROUP BY 1 HAVING count(*) > 1)", "k"
        elif kind == "relationships":
            master, theirs = declared.found_in[column]
            blank = f" AND {column} <> ''" if column in declared.blank_passes else ""
            inner = f"SELECT {text(theirs, column_type(master, theirs))} FROM m_{master} WHERE {theirs} IS NOT NULL"
            source, sample = f"m_{model} WHERE {column} IS NOT NULL{blank} AND {text(column)} NOT IN ({inner})", text(column)
        else:
            values = ", ".join(map(literal, declared.one_of.get(column, ())))
            where = {
                "not_null": f"{column} IS NULL", "accepted_values": f"{column} NOT IN ({values})",
                "accepted_range": f"{column} < {literal(declared.at_least.get(column))}",
            }[kind]
            source, sample = f"m_{model} WHERE {where}", key
        parts.append(
            f"SELECT '{test}' AS test, '{severity}' AS severity, count(*) AS failures, "
            f"replace(replace(min({sample}), chr(31), '/'), chr(30), '') AS sample FROM {source}"
        )
    return " UNION ALL ".join(parts)


@query("dq_catalogue", " UNION ALL ".join(map(_declared_sql, CATALOGUE)))
def _catalogue(t):
    """Every declared test of the marts; one pass over each model, one model after another."""
    return tested_in_turn(t.tested)


# the sales mart, the items and the tests written for one table
RUN_MODELS = ("fact_sales", "dim_item")
_CHECKS = f"""
    {" UNION ALL ".join(map(_declared_sql, RUN_MODELS))}
    UNION ALL SELECT 'unique:raw.oinv.doc_entry', 'error', count(*), min(CAST(k AS VARCHAR))
    FROM (SELECT DocEntry AS k FROM raw_oinv GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'double_entry:journal', 'error', count(*), min(CAST(k AS VARCHAR))
    FROM (SELECT transaction_id AS k FROM {_JOURNAL} GROUP BY 1 HAVING abs(sum(debit) - sum(credit)) > 0.01)"""


def run_counts(t):
    journal = t.w.model("finance_journal_entries", "transaction_id", "debit", "credit")
    own = [
        quality.Check(
            "unique:raw.oinv.doc_entry", quality.unique_keys(t.w.stage("sales_invoice_oinv"), ["doc_entry"]), "doc_entry"
        ),
        quality.Check("double_entry:journal", quality.double_entry(journal), "transaction_id"),
    ]
    return catalogue_results(t.tested, RUN_MODELS).unionByName(quality.counted(own))


RUN_AT = dt.datetime(2026, 1, 1, 6)
_STATUS_OF = "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END"


@query(
    "dq_run_results",
    f"SELECT test, {_STATUS_OF} AS status, severity, failures, sample, '2026-01-01 06:00:00' AS run_at FROM ({_CHECKS})",
)
def _run_results(t):
    return quality.judged(run_counts(t), RUN_AT)


@query(
    "dq_severity",
    f"SELECT {_STATUS_OF} AS status, count(*) AS tests, CAST(sum(failures) AS BIGINT) AS failures FROM ({_CHECKS}) GROUP BY 1",
)
def _severity(t):
    results = quality.judged(run_counts(t), RUN_AT)
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("tests"), F.sum("failures").alias("failures"))


@query(
    "dq_run_history",
    f"""WITH a AS ({_declared_sql("dim_item")}), b AS ({_declared_sql("dim_partner")})
        SELECT test, CAST(2 AS BIGINT) AS runs, CASE WHEN failures = 0 THEN '2026-01-02' END AS last_pass, {_STATUS_OF} AS status,
               failures, CAST(0 AS BIGINT) AS change FROM a
        UNION ALL SELECT test, CAST(1 AS BIGINT), CASE WHEN failures = 0 THEN '2026-01-02' END, {_STATUS_OF}, failures, CAST(NULL AS BIGINT) FROM b""",
)
def _run_history(t):
    """Runs of two days, the first repeated, with the partners tested on the second only; stored and read back."""
    path = f"{work_folder(t.spark)}/runs/{uuid.uuid4().hex}"
    items = catalogue_results(t.tested, ["dim_item"])
    for hour in (6, 18):
        quality.store_run(quality.judged(items, dt.datetime(2026, 1, 1, hour)), path)
    both = items.unionByName(catalogue_results(t.tested, ["dim_partner"]))
    return quality.run_history(quality.store_run(quality.judged(both, dt.datetime(2026, 1, 2, 6)), path))


@query(
    "dq_row_checks",
    """SELECT test, failures FROM (
         SELECT count(*) FILTER (quantity IS NULL) AS quantity_null, count(*) FILTER (line_total < 0 AND document_type = 'invoice' AND canceled <> 'reversal') AS negative_invoice,
                count(*) FILTER (store_code IS NULL) AS store_null FROM m_fact_sales)
       UNPIVOT (failures FOR test IN (quantity_null, negative_invoice, store_null))""",
)
def _row_checks(t):
    """All row-level checks of one table in a single pass."""
    sales = t.w.model("fact_sales", "document_type", "canceled", "quantity", "line_total", "store_code")
    negative = (F.col("line_total") < 0) & (F.col("document_type") == "invoice") & (F.col("canceled") != "reversal")
    return quality.row_check_counts(
        sales,
        {"quantity_null": F.col("quantity").isNull(), "negative_invoice": negative, "store_null": F.col("store_code").isNull()},
    )


@query(
    "dq_volume_anomaly",
    """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2),
       w AS (SELECT *, count(n) OVER b AS points, avg(n) OVER b AS mean, stddev_samp(n) OVER b AS sd FROM s
             WINDOW b AS (PARTITION BY event_type ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       SELECT event_type, CAST(d AS VARCHAR) AS day, n AS row_count,
              CASE WHEN points >= 7 AND sd > 0 THEN round((n - mean) / sd, 6) END AS z_score,
              coalesce(CASE WHEN points >= 7 AND sd > 0 THEN abs((n - mean) / sd) > 2 END, false) AS anomaly FROM w""",
)
def _volume(t):
    series = t.events.groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("row_count"))
    scored = quality.volume_anomaly(series, "event_type", "day", "row_count", threshold=2.0)
    return scored.select("event_type", "day", "row_count", F.round("z_score", 6).alias("z_score"), "anomaly")


# ---- streams, in their batch form ------------------------------------------------------------------


@query(
    "stream_closed_day_flow",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, event_type, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS row_count
       FROM events WHERE CAST(ts AS DATE) < (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY 1, 2""",
)
def _closed_day(t):
    """The newest day of the feed is still open."""
    rows = t.events.select("ts", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    return closed_day_flow(rows, "ts", ["event_type"], "value", as_of=t.events.agg(F.max("ts").cast("date")).scalar())


@query(
    "stream_upsert_latest",
    """SELECT user_id, event_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _upsert_latest(t):
    """State after the first half of the feed, then after the rest."""
    feed = t.events.select("user_id", "ts", "event_id", "event_type", "value")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    state = newest_of(None, feed.where(F.col("ts") < cut), ["user_id"], "ts", "event_id")
    return newest_of(state, feed.where(F.col("ts") >= cut), ["user_id"], "ts", "event_id").drop("ts")
