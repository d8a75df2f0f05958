"""Registered conformed tables, marts and consumer analyses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.contract import COLUMNS, column_type
from ledgerflow.entries import model_sql  # noqa: F401  (fills MODEL_SQL)
from ledgerflow.entries.base import DRIVER_PARAMS, check_column, query, register_model
from ledgerflow.entries.model_sql import day
from ledgerflow.operators.setops import union_labelled
from ledgerflow.plans import analyses
from ledgerflow.plans.common import salesperson_bridge_step
from ledgerflow.plans.marts import calendar, days_between

INTERMEDIATE = (
    "partner item item_price_list warehouse user employee standardized_store salesperson_bridge goal_name_entry "
    "sales_invoice_documents sales_quote_documents sales_return_documents sales_order_documents "
    "sales_invoice_lines sales_quote_lines sales_return_lines sales_order_lines "
    "sales_fiscal_documents sales_fiscal_lines sales_expenses sales_freight_document "
    "sales_delivery_documents sales_delivery_lines sales_installments sales_store_salesperson sales_goals "
    "purchases_invoice_documents purchases_order_documents purchases_requisition_documents "
    "purchases_invoice_lines purchases_order_lines purchases_requisition_lines "
    "purchases_fiscal_documents purchases_fiscal_lines "
    "finance_journal_entries finance_payments current_inventory inventory_movements"
).split()
MARTS = (
    "dim_item dim_partner dim_employees dim_store dim_warehouse fact_sales fact_goals fact_purchases "
    "fact_accounts_receivable fact_inventory fact_daily_inventory_movement"
).split()

for _name in INTERMEDIATE:
    register_model(f"int_{_name}", _name)
for _name in MARTS:
    register_model(_name, _name)
register_model("int_purchases_fiscal_usage", "purchases_fiscal_usage_invoice")


def _per_kind(key: str, prefix: str) -> None:
    kinds = ("invoice", "quote", "return")
    columns = ", ".join(
        check_column(c, column_type(f"{prefix}_invoice", c)) for c in COLUMNS[f"{prefix}_invoice"]
    )
    sql = " UNION ALL ".join(
        f"SELECT '{k}' AS document_type, {columns} FROM m_{prefix}_{k}" for k in kinds
    )
    query(key, sql)(
        lambda t: union_labelled({k: t.w.model(f"{prefix}_{k}") for k in kinds}, "document_type")
    )


_per_kind("int_sales_fiscal_usage", "sales_fiscal_usage")
_per_kind("int_sales_prices", "sales_prices")


@query(
    "dim_date",
    """
    SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
           CAST(month(d) AS INTEGER) AS month, lower(monthname(d)) AS month_name,
           lower(strftime(d, '%b')) AS month_short_name, lower(strftime(d, '%b/%Y')) AS month_year,
           CAST(day(d) AS INTEGER) AS day, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
           CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, lower(dayname(d)) AS day_of_week_name,
           lower(strftime(d, '%a')) AS day_of_week_short_name,
           CASE WHEN dayofweek(d) IN (0, 6) THEN 'yes' ELSE 'no' END AS weekend,
           CAST((dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) // 7 + 1 AS INTEGER) AS week_of_year,
           CAST(weekofyear(d) AS INTEGER) AS iso_week,
           CAST(CAST(date_trunc('week', d + 1) AS DATE) AS VARCHAR) AS week_start,
           CAST(CAST(date_trunc('week', d + 1) AS DATE) + 6 AS VARCHAR) AS week_end,
           CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start,
           CAST(last_day(d) AS VARCHAR) AS month_end,
           CAST(CAST(date_trunc('quarter', d) AS DATE) AS VARCHAR) AS quarter_start,
           CAST(CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH AS DATE) - 1 AS VARCHAR) AS quarter_end,
           CAST(CAST(date_trunc('year', d) AS DATE) AS VARCHAR) AS year_start,
           CAST(make_date(year(d), 12, 31) AS VARCHAR) AS year_end,
           CAST(d - 1 AS VARCHAR) AS previous_day, CAST(d + 1 AS VARCHAR) AS next_day,
           CAST(CAST(d - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS same_day_previous_year
    FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
          FROM (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders))
    """,
)
def _dim_date(t):
    """Calendar over the span of the order dates."""
    day_of = t.orders.select(F.col("o_orderdate").cast("date").alias("d"))
    return calendar(days_between(day_of, "d", "d"))



@query(
    "int_salesperson_bridge_step",
    f"""
    WITH moved AS (
        SELECT b.* REPLACE (CASE WHEN b.salesperson_code % 5 = 2 THEN b.salesperson_code + 1000 ELSE b.salesperson_code END AS salesperson_code),
               CASE WHEN b.salesperson_code % 4 = 1 THEN 'x' || b.store_code ELSE b.store_code END AS was
        FROM m_salesperson_bridge b),
    closed AS (
        SELECT m.* REPLACE (m.was AS store_code,
                 CASE WHEN EXISTS (SELECT 1 FROM raw_oslp o WHERE o.SlpCode = m.salesperson_code
                                   AND length(trim(o.U_STORE)) > 0 AND trim(o.U_STORE) <> m.was)
                      THEN {day(DRIVER_PARAMS.run_date)} - 1 END AS valid_to) FROM moved m)
    SELECT CAST(salesperson_code AS INTEGER) AS salesperson_code, salesperson_name, normalized_name, store_code, store_name,
           store_text, role, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to, source
    FROM (SELECT * EXCLUDE (was) FROM closed
          UNION ALL
          SELECT b.* REPLACE ({day(DRIVER_PARAMS.run_date)} AS valid_from) FROM m_salesperson_bridge b
          WHERE NOT EXISTS (SELECT 1 FROM closed c
                            WHERE c.salesperson_code = b.salesperson_code AND c.valid_to IS NULL))
    """,
)
def _bridge_step(t):
    """Forward run on a state where some codes sat in another store and some had another number."""
    base = t.w.model("salesperson_bridge")
    code = F.col("salesperson_code")
    earlier = base.withColumn(
        "store_code", F.when(code % 4 == 1, F.concat(F.lit("x"), F.col("store_code"))).otherwise(F.col("store_code"))
    ).withColumn("salesperson_code", F.when(code % 5 == 2, code + 1000).otherwise(code))
    return salesperson_bridge_step(t.w, earlier)


@query(
    "revenue_by_month_channel",
    """
    SELECT CAST(CAST(date_trunc('month', date) AS DATE) AS VARCHAR) AS month, presale_channel,
           CAST(CAST(sum(line_total) AS DECIMAL(20,6)) AS DOUBLE) AS net_revenue,
           CAST(CAST(sum(gross_profit) AS DECIMAL(20,6)) AS DOUBLE) AS gross_profit, count(*) AS line_count
    FROM m_fact_sales GROUP BY 1, 2
    """,
)
def _revenue(t):
    return analyses.revenue_by_month_channel(t.w)


@query(
    "goals_vs_sales",
    """
    SELECT g.employee_code, CAST(g.date AS VARCHAR) AS date, CAST(CAST(g.goal AS DECIMAL(20,6)) AS DOUBLE) AS goal,
           CAST(CAST(coalesce(s.rev, 0) AS DECIMAL(20,6)) AS DOUBLE) AS net_revenue,
           CAST(CASE WHEN g.goal > 0 THEN CAST(coalesce(s.rev, 0) / g.goal AS DECIMAL(20,6)) END AS DOUBLE) AS attainment
    FROM (SELECT employee_code, date, sum(daily_goal) AS goal FROM m_fact_goals GROUP BY ALL) g
    LEFT JOIN (SELECT employee_code, date, sum(line_total) AS rev FROM m_fact_sales GROUP BY ALL) s
      ON s.employee_code = g.employee_code AND s.date = g.date
    """,
)
def _goals_vs_sales(t):
    return analyses.goals_vs_sales(t.w)


def exact_ratio(n: str, d: str) -> str:
    """n / d to six decimals, half away from zero, in whole-number arithmetic (d > 0)."""
    n6, d6 = (f"CAST(replace(CAST(CAST({x} AS DECIMAL(38,6)) AS VARCHAR), '.', '') AS HUGEINT)" for x in (n, d))
    return f"CAST(sign({n6}) * ((2 * abs({n6}) * 1000000 + {d6}) // (2 * {d6})) AS DOUBLE) / 1000000"


_RATES = ("unit_price", "price_before_discount", "discount_percentage", "inventory_cost_price")


@query(
    "weighted_unit_rates",
    f"""
    SELECT item_code, CAST(year_start AS VARCHAR) AS year_start, CAST(q AS DOUBLE) AS quantity,
           {', '.join(f'CASE WHEN q > 0 THEN {exact_ratio(r, chr(113))} END AS avg_{r}' for r in _RATES)}
    FROM (SELECT item_code, CAST(date_trunc('year', date) AS DATE) AS year_start, sum(quantity) AS q,
                 {', '.join(f'sum(quantity * {r}) AS {r}' for r in _RATES)}
          FROM m_fact_sales GROUP BY 1, 2)
    """,
)
def _weighted(t):
    return analyses.weighted_unit_rates(t.w)


@query(
    "document_trace",
    """
    WITH inv AS (SELECT DISTINCT doc_entry, source_document_type AS ty, source_doc_entry AS src
                 FROM m_sales_invoice_lines WHERE source_document_type IN (17, 23)),
    ord AS (SELECT DISTINCT doc_entry, source_doc_entry AS src FROM m_sales_order_lines WHERE source_document_type = 23),
    ret AS (SELECT effective_source_doc_entry AS inv, count(DISTINCT doc_entry) AS n, sum(line_total) AS v
            FROM m_sales_return_lines GROUP BY 1)
    SELECT d.doc_entry AS invoice, o.src AS "order", coalesce(q.src, i.src) AS quote,
           coalesce(ret.n, 0) AS return_count, CAST(coalesce(ret.v, 0) AS DOUBLE) AS returned_total
    FROM m_sales_invoice_documents d
    LEFT JOIN inv o ON o.doc_entry = d.doc_entry AND o.ty = 17
    LEFT JOIN ord q ON q.doc_entry = o.src
    LEFT JOIN inv i ON i.doc_entry = d.doc_entry AND i.ty = 23
    LEFT JOIN ret ON ret.inv = d.doc_entry
    """,
)
def _trace(t):
    return analyses.document_trace(t.w)


@query(
    "purchase_trace",
    """
    SELECT document_type, ty AS source_type, count(DISTINCT (doc_entry, source_doc_entry)) AS links
    FROM (SELECT *, CASE source_document_type WHEN 22 THEN 'order' WHEN 18 THEN 'invoice'
                         WHEN 1470000113 THEN 'requisition' END AS ty FROM m_purchases_fiscal_lines)
    WHERE ty IS NOT NULL AND source_doc_entry IS NOT NULL GROUP BY 1, 2
    """,
)
def _purchase_trace(t):
    return analyses.purchase_trace(t.w)


@query(
    "receivables_ageing",
    f"""
    SELECT partner_code, CASE WHEN late <= 0 THEN 'current' WHEN late > 90 THEN '>90' WHEN late > 60 THEN '61-90'
                              WHEN late > 30 THEN '31-60' ELSE '1-30' END AS bucket,
           count(*) AS invoices, CAST(CAST(sum(open_balance) AS DECIMAL(20,6)) AS DOUBLE) AS open_balance
    FROM (SELECT *, {day(DRIVER_PARAMS.as_of)} - last_due_date AS late FROM m_fact_accounts_receivable WHERE open_balance > 0)
    GROUP BY 1, 2
    """,
)
def _ageing(t):
    return analyses.receivables_ageing(t.w)


@query(
    "days_without_movement",
    """
    SELECT item_code, warehouse_code, CAST(date AS VARCHAR) AS date, CAST(nxt AS VARCHAR) AS next_date,
           CAST(nxt - date - 1 AS INTEGER) AS idle_days
    FROM (SELECT *, lead(date) OVER (PARTITION BY item_code, warehouse_code ORDER BY date) AS nxt
          FROM m_fact_daily_inventory_movement)
    """,
)
def _idle(t):
    return analyses.days_without_movement(t.w)


BALANCE_DAY = dt.date(2000, 1, 1)


@query(
    "balance_as_of",
    f"""
    SELECT item_code, warehouse_code, CAST(date AS VARCHAR) AS balance_date,
           CAST(inventory_value_after_movement AS DOUBLE) AS inventory_value_after_movement,
           CAST(quantity_after_movement AS DOUBLE) AS quantity_after_movement
    FROM m_fact_daily_inventory_movement WHERE date <= {day(BALANCE_DAY)}
    QUALIFY row_number() OVER (PARTITION BY item_code, warehouse_code ORDER BY date DESC) = 1
    """,
)
def _balance(t):
    return analyses.balance_as_of(t.w, BALANCE_DAY)
