"""Registered staging projections, cleaning expressions, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.entries.base import DRIVER_PARAMS, query
from ledgerflow.entries.model_sql import day, label, ptbr, segment
from ledgerflow.functions import codes, dates, measures, predicates, text
from ledgerflow.contract import conform
from ledgerflow.sources.staging import STAGING, mapping

AS_OF = DRIVER_PARAMS.as_of

# ---- staging -------------------------------------------------------------------


def _staging_check(name: str) -> str:
    raw = STAGING[name][0]
    columns = []
    for source, staged, rule in mapping(name):
        c = f'"{source}"'
        if rule == "notes":
            c = f"ltrim(translate({c}, chr(13) || chr(9) || chr(160), '   '))"
        elif rule.startswith("ptbr"):
            c = f"CAST({ptbr(c, 'DECIMAL(18,' + rule[-1] + ')')} AS DOUBLE)"
        elif rule == "postal":
            c = f"right('00000000' || translate({c}, '.- /(),' || chr(9), ''), 8)"
        elif rule.startswith("decimal"):
            c = f"CAST(CAST({c} AS {rule}) AS DOUBLE)"
        elif rule == "date":
            c = f"CAST(CAST({c} AS DATE) AS VARCHAR)"
        elif source in ("LineNum", "BaseLine", "DocLineNum", "TransNum"):
            c = f"CAST({c} AS VARCHAR)"
        columns.append(f"{c} AS {staged}")
    return f"SELECT {', '.join(columns)}, strftime(_ingested_at, '%Y-%m-%d %H:%M:%S') AS _ingested_at FROM raw_{raw}"


def _register_staging(name: str) -> None:
    query(f"stg_{name}", _staging_check(name))(lambda t: t.w.stage(name))


for _name in STAGING:
    _register_staging(_name)

query("stg_project_cast", _staging_check("sales_invoice_oinv"))(lambda t: t.w.stage("sales_invoice_oinv"))

# ---- cleaning ------------------------------------------------------------------


@query(
    "clean_notes",
    """SELECT p_partkey, ltrim(replace(replace(replace(n, chr(13), ' '), chr(9), ' '), chr(160), ' ')) AS notes
       FROM (SELECT p_partkey, chr(9) || ' ' || chr(160) || p_name || chr(13) || chr(10) || p_type || chr(9) AS n FROM part)""",
)
def _notes(t):
    raw = F.concat(F.lit("\t \u00a0"), "p_name", F.lit("\r\n"), "p_type", F.lit("\t"))
    return t.part.select("p_partkey", text.clean_notes(raw).alias("notes"))


_PRICE_TEXT = """CASE l_linenumber % 4 WHEN 0 THEN '1.058,5' || CAST(l_partkey % 10 AS STRING)
    WHEN 1 THEN CAST(l_partkey AS STRING) || ',75' WHEN 2 THEN CAST(l_quantity AS STRING) ELSE 'n/a' END"""


@query(
    "ptbr_decimal",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, p AS price_text,
               CAST({ptbr('p', 'DECIMAL(18,2)')} AS DOUBLE) AS price
        FROM (SELECT *, {_PRICE_TEXT} AS p FROM lineitem)""",
)
def _ptbr(t):
    rows = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_partkey", f"{_PRICE_TEXT} AS price_text")
    return rows.withColumn("price", text.ptbr_decimal(F.col("price_text")))


@query(
    "digits_only",
    "SELECT c_custkey, regexp_replace('(21) ' || c_custkey || '/4.5-6,7' || chr(9) || c_mktsegment, '[-. /(),\\t]', '', 'g') AS digits FROM customer",
)
def _digits(t):
    raw = F.concat(F.lit("(21) "), F.col("c_custkey").cast("string"), F.lit("/4.5-6,7\t"), "c_mktsegment")
    return t.customer.select("c_custkey", text.digits_only(raw).alias("digits"))


@query(
    "zero_pad_postal",
    """SELECT c_custkey, right('00000000' || replace(code, '-', ''), 8) AS postal_code
       FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN '9876543210' || c_custkey
                                    ELSE '12-' || c_custkey END AS code FROM customer)""",
)
def _postal(t):
    key = F.col("c_custkey").cast("string")
    code = F.when(F.col("c_custkey") % 5 == 1, F.concat(F.lit("9876543210"), key)).when(
        F.col("c_custkey") % 5 != 0, F.concat(F.lit("12-"), key)
    )
    return t.customer.select("c_custkey", text.zero_pad_postal(code).alias("postal_code"))


_CODED = {
    "document_status": ("DocStatus", codes.DOCUMENT_STATUS), "canceled": ("CANCELED", codes.CANCELED),
    "load_kit": ("U_LOAD_KIT", codes.LOAD_KIT), "quote_load_kit": ("U_LOAD_KIT", codes.LOAD_KIT_QUOTE),
    "presale_channel": ("U_PRESALE", codes.PRESALE_CHANNEL), "finance_validated": ("U_FINANCE_VALIDATED", codes.FINANCE_VALIDATED),
    "show_in_bi": ("U_SHOW_IN_BI", codes.SIM_NAO), "triangulation": ("U_TRIANGULATION", codes.TRIANGULATION),
}


@query(
    "translate_codes",
    "SELECT DocEntry AS doc_entry, "
    + ", ".join(f"{label(c, m)} AS {out}" for out, (c, m) in _CODED.items())
    + " FROM raw_oinv",
)
def _codes(t):
    return t.w.raw("oinv").select(
        F.col("DocEntry").alias("doc_entry"),
        *(codes.translate_code(F.col(c), m).alias(out) for out, (c, m) in _CODED.items()),
    )


@query(
    "movement_type_slug",
    "SELECT CAST(TransNum AS VARCHAR) AS transaction_number, CASE TransType "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in codes.MOVEMENT_TYPE.items())
    + " ELSE 'type_' || TransType END AS slug FROM raw_oinm",
)
def _slug(t):
    return t.w.stage("inventory_movement_oinm").select(
        "transaction_number", codes.movement_type_slug(F.col("transaction_type")).alias("slug")
    )


@query(
    "movement_direction",
    """SELECT CAST(TransNum AS VARCHAR) AS transaction_number,
              CASE WHEN InQty > 0 AND OutQty = 0 THEN 'inflow' WHEN OutQty > 0 AND InQty = 0 THEN 'outflow'
                   WHEN InQty = 0 AND OutQty = 0 THEN 'value_adjustment' ELSE 'mixed' END AS direction
       FROM raw_oinm""",
)
def _direction(t):
    return t.w.stage("inventory_movement_oinm").select(
        "transaction_number",
        measures.movement_direction(F.col("inflow_quantity"), F.col("outflow_quantity")).alias("direction"),
    )


@query("surrogate_document_id", "SELECT o_orderkey, format('orc-{}', o_orderkey) AS document_id FROM orders")
def _document_id(t):
    return t.orders.select("o_orderkey", text.prefixed_id("orc", F.col("o_orderkey")).alias("document_id"))


@query(
    "line_key",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN l_orderkey || '/'
              ELSE concat(l_orderkey, '/', l_linenumber) END AS line_key FROM lineitem""",
)
def _line_key(t):
    number = F.nullif(F.col("l_linenumber"), F.lit(3))
    return t.lineitem.select("l_orderkey", "l_linenumber", text.line_key(F.col("l_orderkey"), number).alias("line_key"))


@query(
    "null_padded_schema",
    "SELECT doc_entry, document_type, CAST(price_before_discount AS DOUBLE) AS price_before_discount, usage_id, cfop, "
    "CAST(margin AS DOUBLE) AS margin, CAST(open_quantity AS DOUBLE) AS open_quantity FROM m_sales_order_lines",
)
def _padded(t):
    """Order lines fitted to the shared line schema: what they lack is NULL."""
    lines = t.w.stage("sales_order_lines_rdr1").withColumn("document_type", F.lit("order"))
    return conform(lines, "sales_order_lines").select(
        "doc_entry", "document_type", "price_before_discount", "usage_id", "cfop", "margin", "open_quantity"
    )


@query(
    "name_segments",
    f"""SELECT DISTINCT "Vendedor" AS full_name, lower({segment('"Vendedor"', 1)}) AS name,
               {segment('"Vendedor"', 2)} AS store, {segment('"Vendedor"', 3)} AS role
        FROM (SELECT * FROM raw_retail_goals UNION ALL SELECT * FROM raw_wholesale_goals)""",
)
def _segments(t):
    goals = t.w.stage("retail_goals").unionByName(t.w.stage("wholesale_goals"))
    name = F.col("salesperson")
    return goals.select(
        name.alias("full_name"), text.normalized_name(name).alias("name"),
        text.name_segment(name, 2).alias("store"), text.name_segment(name, 3).alias("role"),
    ).distinct()


_MARKED_NAME = """CASE c_custkey % 4 WHEN 0 THEN 'NÃO UTILIZAR - ' || c_name || ' - Loja' WHEN 1 THEN 'nao utilizar -  ' || c_name
    WHEN 2 THEN 'Não utilizar' ELSE c_name || ' - Mega - Vendedor' END"""


@query(
    "strip_retired_prefix",
    f"""SELECT c_custkey, string_split(CASE WHEN c_custkey % 4 < 2 THEN ltrim(lower(n)[15:]) ELSE lower(n) END, ' - ')[1] AS name
        FROM (SELECT c_custkey, {_MARKED_NAME} AS n FROM customer)""",
)
def _retired(t):
    rows = t.customer.selectExpr("c_custkey", f"{_MARKED_NAME} AS n")
    return rows.select("c_custkey", text.canonical_name(F.col("n")).alias("name"))


@query(
    "active_status",
    f"""SELECT c_custkey, CASE WHEN strip_accents(lower(n)) LIKE 'nao utilizar%' THEN 'inactive' ELSE 'active' END AS status
        FROM (SELECT c_custkey, {_MARKED_NAME} AS n FROM customer)""",
)
def _active(t):
    rows = t.customer.selectExpr("c_custkey", f"{_MARKED_NAME} AS n")
    return rows.select("c_custkey", text.active_status(F.col("n")).alias("status"))


@query("tax_id_normalized", "SELECT partner_code, cpf_cnpj_normalized AS tax_id FROM m_partner")
def _tax_id(t):
    return t.w.stage("business_partner_ocrd").select(
        "partner_code", text.tax_id_normalized(F.col("password"), F.col("partner_code")).alias("tax_id")
    )


@query("tax_id_bucket", "SELECT cpf_cnpj_type AS bucket, count(*) AS partners FROM m_dim_partner GROUP BY 1")
def _tax_bucket(t):
    tax_id = text.tax_id_normalized(F.col("password"), F.col("partner_code"))
    return (
        t.w.stage("business_partner_ocrd").groupBy(text.tax_id_bucket(tax_id).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("partners"))
    )


@query("item_type", "SELECT item_code, item_type FROM m_dim_item")
def _item_type(t):
    flags = (F.col("is_sellable"), F.col("is_stockable"), F.col("is_purchased"))
    items = t.w.model("item", "item_code", "is_sellable", "is_stockable", "is_purchased")
    return items.select("item_code", text.item_type(*flags).alias("item_type"))


@query("code_prefix_category", "SELECT code_prefix, category_code, count(*) AS items FROM m_dim_item GROUP BY 1, 2")
def _category(t):
    code = F.col("item_code")
    return (
        t.w.model("item", "item_code")
        .groupBy(text.item_prefix(code).alias("code_prefix"), text.item_category(code).alias("category_code"))
        .agg(F.count(F.lit(1)).alias("items"))
    )


@query(
    "fallback_label",
    "SELECT doc_entry, display_store_name, presale_channel, CAST(freight_amount AS DOUBLE) AS freight_amount FROM m_sales_invoice_documents",
)
def _fallback(t):
    return t.w.model("sales_invoice_documents", "doc_entry", "display_store_name", "presale_channel", "freight_amount")


@query(
    "sign_rule",
    """SELECT document_type, canceled, CAST(CASE WHEN document_type = 'return' AND canceled = 'reversal' THEN 1
                                                     WHEN document_type = 'return' OR canceled = 'reversal' THEN -1 ELSE 1 END AS INTEGER) AS sign,
              count(*) AS documents
       FROM m_sales_fiscal_documents GROUP BY ALL""",
)
def _sign(t):
    sign = measures.sales_sign(F.col("document_type"), F.col("canceled"))
    docs = t.w.model("sales_fiscal_documents", "document_type", "canceled")
    return docs.groupBy("document_type", "canceled", sign.alias("sign")).agg(F.count(F.lit(1)).alias("documents"))


@query(
    "signed_measures",
    """SELECT document_type, count(*) AS lines, CAST(sum(quantity) AS DOUBLE) AS quantity, CAST(sum(line_total) AS DOUBLE) AS line_total,
              CAST(CAST(sum(total_cost) AS DECIMAL(38,6)) AS DOUBLE) AS total_cost,
              CAST(CAST(sum(gross_profit) AS DECIMAL(38,6)) AS DOUBLE) AS gross_profit
       FROM m_fact_sales GROUP BY 1""",
)
def _signed(t):
    additive = ("quantity", "line_total", "total_cost", "gross_profit")
    sales = t.w.model("fact_sales", "document_type", *additive)
    return sales.groupBy("document_type").agg(
        F.count(F.lit(1)).alias("lines"), *(measures.total(F.sum(c)).alias(c) for c in additive)
    )


@query(
    "sentinel_to_null",
    "SELECT DocEntry AS doc_entry, CASE WHEN SlpCode <> -1 THEN SlpCode END AS salesperson_code FROM raw_oinv",
)
def _sentinel(t):
    return t.w.stage("sales_invoice_oinv").select(
        "doc_entry", measures.sentinel_to_null(F.col("salesperson_code")).alias("salesperson_code")
    )


@query(
    "guarded_division",
    """SELECT CAST(TransNum AS VARCHAR) AS transaction_number,
              CASE WHEN CalcPrice > 0 THEN CAST(CAST(Balance / CalcPrice AS DECIMAL(20,6)) AS DOUBLE) END AS quantity_after
       FROM raw_oinm""",
)
def _guarded(t):
    ratio = measures.guarded_ratio(F.col("inventory_value_after_movement"), F.col("calculated_average_price"))
    return t.w.stage("inventory_movement_oinm").select("transaction_number", ratio.alias("quantity_after"))


@query(
    "payment_status",
    """SELECT DocEntry AS doc_entry, InstlmntID AS installment,
              CASE WHEN InsTotal <= Paid THEN 'paid' WHEN Paid = 0 THEN 'open' ELSE 'partial' END AS status FROM raw_inv6""",
)
def _payment(t):
    status = measures.payment_status(F.col("paid_amount"), F.col("installment_amount"))
    return t.w.stage("sales_invoice_installments_inv6").select(
        "doc_entry", F.col("installment_number").alias("installment"), status.alias("status")
    )


# ---- filters ---------------------------------------------------------------------


@query(
    "filter_sales_visibility",
    """SELECT doc_entry, branch_id FROM m_sales_invoice_documents
       WHERE partner_show_in_bi = 'yes' AND (branch_id = 9 OR group_code <> 111)""",
)
def _visible(t):
    docs = t.w.model("sales_invoice_documents", "doc_entry", "branch_id", "partner_show_in_bi", "group_code")
    keep = predicates.sales_visible(F.col("partner_show_in_bi"), F.col("group_code"), F.col("branch_id"))
    return docs.where(keep).select("doc_entry", "branch_id")


@query(
    "filter_purchases_visibility",
    """SELECT doc_entry FROM m_purchases_invoice_documents
       WHERE canceled = 'no' AND partner_show_in_bi = 'yes' AND group_code <> 111""",
)
def _purchases_visible(t):
    columns = ("canceled", "partner_show_in_bi", "group_code")
    docs = t.w.model("purchases_invoice_documents", "doc_entry", *columns)
    return docs.where(predicates.purchases_visible(*(F.col(c) for c in columns))).select("doc_entry")


@query("filter_usage_whitelist", "SELECT Usage AS usage_id, count(*) AS lines FROM raw_inv1 WHERE Usage IN (9, 10, 20, 22, 37, 46, 56) GROUP BY 1")
def _usage(t):
    lines = t.w.stage("sales_invoice_lines_inv1").where(predicates.sales_usage(F.col("usage_id")))
    return lines.groupBy("usage_id").agg(F.count(F.lit(1)).alias("lines"))


@query("filter_return_header_usage", "SELECT DocEntry AS doc_entry FROM raw_rin12 WHERE MainUsage = 24")
def _return_usage(t):
    return t.w.stage("sales_return_usage_rin12").where(predicates.return_header_usage(F.col("main_usage"))).select("doc_entry")


@query(
    "filter_force_display",
    """SELECT doc_entry, document_show_in_bi FROM m_sales_invoice_documents
       WHERE document_show_in_bi = 'yes' OR (partner_show_in_bi = 'yes' AND (branch_id = 9 OR group_code <> 111))""",
)
def _force(t):
    docs = t.w.model(
        "sales_invoice_documents", "doc_entry", "document_show_in_bi", "partner_show_in_bi", "group_code", "branch_id"
    )
    normal = predicates.sales_visible(F.col("partner_show_in_bi"), F.col("group_code"), F.col("branch_id"))
    keep = predicates.force_display(F.col("document_show_in_bi"), normal)
    return docs.where(keep).select("doc_entry", "document_show_in_bi")


@query(
    "filter_canceled_returns",
    """SELECT document_type, canceled, count(*) AS documents FROM m_sales_fiscal_documents
       WHERE document_type <> 'return' OR canceled = 'no' GROUP BY ALL""",
)
def _canceled_returns(t):
    docs = t.w.model("sales_fiscal_documents", "document_type", "canceled")
    keep = predicates.not_canceled_return(F.col("document_type"), F.col("canceled"))
    return docs.where(keep).groupBy("document_type", "canceled").agg(F.count(F.lit(1)).alias("documents"))


@query("filter_commercial_purchase", "SELECT DocEntry AS doc_entry, CAST(LineNum AS VARCHAR) AS line_number FROM raw_pch1 WHERE Usage = 3")
def _commercial(t):
    lines = t.w.stage("purchase_invoice_lines_pch1").where(predicates.commercial_purchase(F.col("usage_id")))
    return lines.select("doc_entry", "line_number")


@query(
    "filter_valid_salesperson",
    """SELECT SlpCode AS salesperson_code, count(DocEntry) AS documents FROM raw_oslp LEFT JOIN raw_oinv USING (SlpCode)
       WHERE SlpCode >= 0 AND SlpCode NOT IN (184, 188) AND trim(raw_oslp.U_STORE) <> ''
         AND NOT starts_with(strip_accents(lower(SlpName)), 'nao utilizar') GROUP BY 1""",
)
def _valid_salesperson(t):
    columns = ("salesperson_code", "salesperson_name", "store_code")
    people = t.w.stage("salesperson_oslp").where(predicates.bridge_salesperson(*(F.col(c) for c in columns)))
    docs = t.w.stage("sales_invoice_oinv").select("salesperson_code", "doc_entry")
    return people.join(docs, "salesperson_code", "left").groupBy("salesperson_code").agg(
        F.count("doc_entry").alias("documents")
    )


@query("filter_goals", 'SELECT "Vendedor" AS salesperson, count(*) AS goals FROM m_goal_rows GROUP BY 1')
def _goals(t):
    sheets = t.w.stage("retail_goals").unionByName(t.w.stage("wholesale_goals"))
    keep = predicates.listed_goal(F.col("date"), F.col("salesperson"), DRIVER_PARAMS.goal_min_year)
    return sheets.where(keep).groupBy("salesperson").agg(F.count(F.lit(1)).alias("goals"))


@query(
    "filter_goals_mart",
    f"""SELECT channel, CAST(date AS VARCHAR) AS date, salesperson_code, original_goal_store FROM m_sales_goals
        WHERE year(date) >= {DRIVER_PARAMS.goal_mart_min_year} AND salesperson_code IS NOT NULL""",
)
def _goals_mart(t):
    goals = t.w.model("sales_goals", "channel", "date", "salesperson_code", "original_goal_store")
    return goals.where(
        predicates.resolved_goal(F.col("date"), F.col("salesperson_code"), DRIVER_PARAMS.goal_mart_min_year)
    )


@query(
    "filter_closed_days",
    f"SELECT CAST(TransNum AS VARCHAR) AS transaction_number, CAST(CAST(DocDate AS DATE) AS VARCHAR) AS movement_date FROM raw_oinm WHERE DocDate < {day(AS_OF)}",
)
def _closed(t):
    rows = t.w.stage("inventory_movement_oinm").select("transaction_number", "movement_date")
    return rows.where(predicates.closed_day(F.col("movement_date"), AS_OF))


@query(
    "filter_active_warehouse",
    "SELECT warehouse_code, count(*) AS items FROM m_current_inventory WHERE warehouse_inactive <> 'yes' GROUP BY 1",
)
def _active_warehouse(t):
    stock = t.w.model("current_inventory", "warehouse_code", "warehouse_inactive")
    keep = predicates.active_warehouse(F.col("warehouse_inactive"))
    return stock.where(keep).groupBy("warehouse_code").agg(F.count(F.lit(1)).alias("items"))


@query(
    "filter_freight_expense",
    "SELECT DocEntry AS doc_entry, CAST(LineNum AS VARCHAR) AS line_number, CAST(LineTotal AS DOUBLE) AS expense_amount FROM raw_inv3 WHERE ExpnsCode = 1",
)
def _freight(t):
    rows = t.w.stage("sales_invoice_expenses_inv3").where(predicates.freight_expense(F.col("expense_code")))
    return rows.select("doc_entry", "line_number", "expense_amount")


@query(
    "filter_document_types",
    """SELECT document_type, count(*) AS lines, CAST(sum(line_total) AS DOUBLE) AS line_total FROM m_sales_fiscal_lines
       WHERE document_type IN ('invoice', 'return') GROUP BY 1""",
)
def _types(t):
    """The constant type of each union branch lets the optimizer drop the others."""
    lines = t.w.model("sales_fiscal_lines", "document_type", "line_total")
    return lines.where(F.col("document_type").isin("invoice", "return")).groupBy("document_type").agg(
        F.count(F.lit(1)).alias("lines"), measures.total(F.sum("line_total")).alias("line_total")
    )


@query(
    "param_price_list",
    f"SELECT ItemCode AS item_code, CAST(Price AS DOUBLE) AS list_price FROM raw_itm1 WHERE PriceList = {DRIVER_PARAMS.price_list}",
)
def _price_list(t):
    prices = t.w.model("item_price_list", "item_code", "price_list_number", "list_price")
    return prices.where(F.col("price_list_number") == t.w.params.price_list).drop("price_list_number")


# ---- scalar functions ----------------------------------------------------------------


@query("str_lower", "SELECT c_custkey, lower(c_name) AS name, lower('ÇÃO ' || c_mktsegment) AS segment FROM customer")
def _lower(t):
    return t.customer.select(
        "c_custkey", F.lower("c_name").alias("name"), F.lower(F.concat(F.lit("ÇÃO "), "c_mktsegment")).alias("segment")
    )


@query(
    "str_trim",
    "SELECT p_partkey, ltrim('  ' || p_name || ' ') || '|' AS l, rtrim('  ' || p_name || '  ') || '|' AS r, trim(' ' || p_name || '  ') AS b FROM part",
)
def _trim(t):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return t.part.select(
        "p_partkey", F.concat(F.ltrim(padded), F.lit("|")).alias("l"), F.concat(F.rtrim(padded), F.lit("|")).alias("r"),
        F.trim(padded).alias("b"),
    )


@query("str_substring", "SELECT p_partkey, substr(p_type, 1, 2) AS head, substr(p_name, 3, 4) AS middle FROM part")
def _substring(t):
    return t.part.select("p_partkey", F.substring("p_type", 1, 2).alias("head"), F.substring("p_name", 3, 4).alias("middle"))


@query(
    "str_charindex",
    """SELECT c_custkey, CAST(instr(c_name, '#') AS INTEGER) AS first_hit,
              CAST(CASE WHEN instr(substr(c_name, 11), '0') = 0 THEN 0 ELSE 10 + instr(substr(c_name, 11), '0') END AS INTEGER) AS later_hit
       FROM customer""",
)
def _charindex(t):
    return t.customer.select(
        "c_custkey", F.locate("#", "c_name").alias("first_hit"), F.locate("0", "c_name", 11).alias("later_hit")
    )


@query("str_len", "SELECT p_partkey, CAST(length(rtrim(p_name || '   ')) AS INTEGER) AS length FROM part")
def _len(t):
    return t.part.select("p_partkey", text.text_length(F.concat("p_name", F.lit("   "))).alias("length"))


@query("str_right", "SELECT c_custkey, right(c_name, 4) AS tail FROM customer")
def _right(t):
    return t.customer.select("c_custkey", F.right("c_name", F.lit(4)).alias("tail"))


@query("str_replace", "SELECT c_custkey, replace(replace(c_name, '#', '/'), '00', '-') AS name FROM customer")
def _replace(t):
    once = F.replace("c_name", F.lit("#"), F.lit("/"))
    return t.customer.select("c_custkey", F.replace(once, F.lit("00"), F.lit("-")).alias("name"))


@query(
    "str_concat_null",
    """SELECT o_orderkey, 'S' || coalesce(p, '') AS lenient, 'S' || p AS strict
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS p FROM orders)""",
)
def _concat(t):
    part = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey", F.concat_ws("", F.lit("S"), part).alias("lenient"), F.concat(F.lit("S"), part).alias("strict")
    )


@query(
    "str_like",
    """SELECT p_partkey, p_name LIKE 'red%' AS prefix, p_type NOT LIKE '%M%' AS no_m,
              (p_name || '_x') LIKE '%^_x' ESCAPE '^' AS escaped FROM part""",
)
def _like(t):
    return t.part.select(
        "p_partkey", F.col("p_name").startswith("red").alias("prefix"), (~F.col("p_type").like("%M%")).alias("no_m"),
        F.expr("concat(p_name, '_x') LIKE '%^_x' ESCAPE '^'").alias("escaped"),
    )


@query(
    "str_collate",
    """SELECT a.n_nationkey, strip_accents(lower('NAÇÃO ' || a.n_name)) = 'nacao ' || lower(a.n_name) AS same,
              strip_accents(lower('São ' || c.c_mktsegment)) AS folded, c.c_custkey
       FROM customer c JOIN nation a ON a.n_nationkey = c.c_nationkey""",
)
def _collate(t):
    accented = F.concat(F.lit("NAÇÃO "), "n_name")
    plain = F.concat(F.lit("nacao "), F.lower("n_name"))
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.select(
        "n_nationkey",
        (F.collate(accented, "UNICODE_CI_AI") == F.collate(plain, "UNICODE_CI_AI")).alias("same"),
        text.fold(F.concat(F.lit("São "), "c_mktsegment")).alias("folded"),
        "c_custkey",
    )


@query(
    "str_control_chars",
    "SELECT p_partkey, translate(p_name || chr(13) || chr(9) || chr(160) || p_type, chr(13) || chr(9) || chr(160), '<->') AS name FROM part",
)
def _control(t):
    raw = F.concat("p_name", F.lit("\r\t\u00a0"), "p_type")
    return t.part.select("p_partkey", F.translate(raw, "\r\t\u00a0", "<->").alias("name"))


@query(
    "cast_types",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS DOUBLE) AS amount,
              strftime(o_orderdate, '%Y-%m-%d') AS iso_day, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
              CAST(o_orderkey AS VARCHAR) AS key_text FROM orders""",
)
def _cast(t):
    return t.orders.select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,4)").alias("amount"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("iso_day"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderkey").cast("string").alias("key_text"),
    )


@query(
    "cast_try",
    """SELECT "U_LEAD_TIME" AS lead_text, count(*) AS items,
              CASE WHEN trim("U_LEAD_TIME") = '' THEN 0 ELSE TRY_CAST(trim("U_LEAD_TIME") AS INTEGER) END AS lead_days,
              CAST(TRY_CAST(trim("U_LEAD_TIME") AS DECIMAL(18,2)) AS DOUBLE) AS lead_amount
       FROM raw_oitm GROUP BY ALL""",
)
def _try(t):
    lead = F.col("lead_time_days")
    return t.w.stage("item_master_oitm").groupBy(lead.alias("lead_text")).agg(F.count(F.lit(1)).alias("items")).select(
        "lead_text", "items", text.lenient_int(F.col("lead_text")).alias("lead_days"),
        F.col("lead_text").try_cast("decimal(18,2)").alias("lead_amount"),
    )


@query(
    "null_functions",
    """SELECT DocEntry AS doc_entry, coalesce(U_Store, 'none') AS store, nullif(SlpCode, -1) AS seller,
              CASE WHEN U_SHOW_IN_BI IS NULL THEN '?' ELSE U_SHOW_IN_BI END AS shown FROM raw_oinv""",
)
def _nulls(t):
    return t.w.raw("oinv").select(
        F.col("DocEntry").alias("doc_entry"), F.coalesce("U_Store", F.lit("none")).alias("store"),
        F.nullif(F.col("SlpCode"), F.lit(-1)).alias("seller"), F.ifnull(F.col("U_SHOW_IN_BI"), F.lit("?")).alias("shown"),
    )


@query(
    "case_forms",
    """SELECT WhsCode AS warehouse_code, CASE Inactive WHEN 'Y' THEN 'yes' WHEN 'N' THEN 'no' ELSE lower(Inactive) END AS simple,
              CASE WHEN Inactive = 'Y' AND BPLid > 4 THEN 'closed branch' WHEN Inactive IS NULL THEN 'unknown' ELSE 'other' END AS searched
       FROM raw_owhs""",
)
def _case(t):
    inactive, branch = F.col("inactive"), F.col("branch_id")
    searched = F.when((inactive == "Y") & (branch > 4), "closed branch").when(inactive.isNull(), "unknown")
    return t.w.stage("warehouse_owhs").select(
        "warehouse_code", codes.translate_code(inactive, codes.YES_NO).alias("simple"),
        searched.otherwise("other").alias("searched"),
    )


def order_days(t):
    return t.orders.select(F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("d"))


_DAYS = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"


def _int(expr: str, name: str) -> str:
    return f"CAST({expr} AS INTEGER) AS {name}"


@query(
    "date_parts",
    "SELECT o_orderkey, " + ", ".join(
        _int(e, n) for n, e in {
            "year": "year(d)", "quarter": "quarter(d)", "month": "month(d)", "day": "day(d)", "day_of_year": "dayofyear(d)",
            "weekday": "isodow(d) % 7 + 1", "iso_week": "weekofyear(d)",
        }.items()
    ) + f" FROM {_DAYS}",
)
def _parts(t):
    d = F.col("d")
    return order_days(t).select(
        "o_orderkey", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.day(d).alias("day"),
        F.dayofyear(d).alias("day_of_year"), F.dayofweek(d).alias("weekday"), F.weekofyear(d).alias("iso_week"),
    )


@query(
    "date_week_us",
    f"SELECT o_orderkey, {_int('(dayofyear(d) + dayofweek(make_date(year(d), 1, 1)) - 1) // 7 + 1', 'week_of_year')} FROM {_DAYS}",
)
def _week_us(t):
    return order_days(t).select("o_orderkey", dates.week_of_year_us(F.col("d")).alias("week_of_year"))


@query(
    "date_week_bounds",
    f"SELECT o_orderkey, CAST(d + 1 - CAST(isodow(d) % 7 AS INTEGER) AS VARCHAR) AS week_start, CAST(d + 7 - CAST(isodow(d) % 7 AS INTEGER) AS VARCHAR) AS week_end FROM {_DAYS}",
)
def _week_bounds(t):
    d = F.col("d")
    return order_days(t).select("o_orderkey", dates.week_start(d).alias("week_start"), dates.week_end(d).alias("week_end"))


_PERIODS = ("month", "quarter", "year")


@query(
    "date_period_bounds",
    "SELECT o_orderkey, " + ", ".join(
        f"CAST(CAST(date_trunc('{p}', d) AS DATE) AS VARCHAR) AS {p}_start, "
        f"CAST(CAST(date_trunc('{p}', d) + INTERVAL {n} MONTH AS DATE) - 1 AS VARCHAR) AS {p}_end"
        for p, n in zip(_PERIODS, (1, 3, 12))
    ) + f" FROM {_DAYS}",
)
def _period_bounds(t):
    d = F.col("d")
    bounds = [f(d, p).alias(f"{p}_{s}") for p in _PERIODS for s, f in (("start", dates.period_start), ("end", dates.period_end))]
    return order_days(t).select("o_orderkey", *bounds)


@query(
    "date_shift",
    f"""SELECT o_orderkey, CAST(d - 30 AS VARCHAR) AS month_ago, CAST(d + 1 AS VARCHAR) AS next_day,
               CAST(CAST(d - INTERVAL 1 YEAR AS DATE) AS VARCHAR) AS year_ago FROM {_DAYS}""",
)
def _shift(t):
    d = F.col("d")
    return order_days(t).select(
        "o_orderkey", F.date_sub(d, 30).alias("month_ago"), F.date_add(d, 1).alias("next_day"),
        F.add_months(d, -12).alias("year_ago"),
    )


@query(
    "date_diff",
    """SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INTEGER) AS days,
              date_diff('minute', ts, TIMESTAMP '2024-02-01 00:00:00') AS minutes,
              date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00') AS seconds FROM events""",
)
def _diff(t):
    end = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id", F.date_diff(F.lit(dt.date(2024, 2, 1)), F.col("ts").cast("date")).alias("days"),
        dates.minutes_between(F.col("ts"), end).alias("minutes"), dates.seconds_between(F.col("ts"), end).alias("seconds"),
    )


@query(
    "date_construct",
    """SELECT event_id, CAST(make_date(year(ts), 1, 1) AS VARCHAR) AS year_start,
              strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS rebuilt FROM events""",
)
def _construct(t):
    ymd = F.expr("year(ts) * 10000 + month(ts) * 100 + day(ts)")
    hms = F.expr("hour(ts) * 10000 + minute(ts) * 100 + second(ts)")
    return t.events.select(
        "event_id", F.make_date(F.year("ts"), F.lit(1), F.lit(1)).alias("year_start"),
        dates.timestamp_of_ints(ymd, hms).alias("rebuilt"),
    )


@query(
    "date_trunc_epoch",
    "SELECT event_id, " + ", ".join(
        f"strftime(CAST(date_trunc('{p}', ts) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS {p}_start" for p in ("minute", "hour", "day", "month", "quarter", "year")
    ) + " FROM events",
)
def _trunc(t):
    parts = ("minute", "hour", "day", "month", "quarter", "year")
    return t.events.select("event_id", *(F.date_trunc(p, "ts").alias(f"{p}_start") for p in parts))


@query(
    "date_now",
    f"SELECT o_orderkey, CAST({day(AS_OF)} - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days, o_orderdate < {day(AS_OF)} AS closed FROM orders",
)
def _now(t):
    """`Now` is a parameter of the run, never the clock."""
    rows = order_days(t)
    return rows.select(
        "o_orderkey", F.date_diff(F.lit(AS_OF), "d").alias("age_days"), predicates.closed_day(F.col("d"), AS_OF).alias("closed")
    )


@query(
    "date_labels",
    f"""SELECT o_orderkey, lower(monthname(d)) AS month_name, lower(left(monthname(d), 3)) AS month_short_name,
               lower(dayname(d)) AS weekday_name, lower(left(dayname(d), 3)) AS weekday_short_name,
               lower(left(monthname(d), 3)) || '/' || year(d) AS month_year FROM {_DAYS}""",
)
def _labels(t):
    d = F.col("d")
    return order_days(t).select(
        "o_orderkey", dates.month_name(d).alias("month_name"), dates.month_short_name(d).alias("month_short_name"),
        dates.weekday_name(d).alias("weekday_name"), dates.weekday_short_name(d).alias("weekday_short_name"),
        dates.month_year_label(d).alias("month_year"),
    )


@query(
    "math_ops",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_partkey // 100 AS whole, l_partkey % 100 AS rest,
              abs(l_linenumber - 4) AS distance, -l_quantity AS negated, l_extendedprice / l_quantity AS rate,
              l_quantity * 2 + 1 - l_tax AS mixed FROM lineitem""",
)
def _math(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_partkey div 100 AS whole", "l_partkey % 100 AS rest",
        "abs(l_linenumber - 4) AS distance", "-l_quantity AS negated", "l_extendedprice / l_quantity AS rate",
        "l_quantity * 2 + 1 - l_tax AS mixed",
    )


