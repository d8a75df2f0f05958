"""Check SQL of every model, over the raw tables.

Written for the checking engine, one statement per model, independent of how
the Spark plans split, prune or order the work.
"""

from __future__ import annotations

from collections.abc import Mapping

from ledgerflow.contract import COLUMNS, column_type
from ledgerflow.entries.base import DRIVER_PARAMS, MODEL_SQL
from ledgerflow.functions import codes

P = DRIVER_PARAMS


def day(value) -> str:
    return f"DATE '{value.isoformat()}'"


def label(c: str, labels: Mapping) -> str:
    whens = " ".join(
        f"WHEN {k!r} THEN {'NULL' if v is None else repr(v)}" for k, v in labels.items()
    )
    return f"CASE {c} {whens} ELSE lower({c}) END"


def newest(raw: str, *keys: str) -> str:
    return (
        f"(SELECT * FROM {raw} QUALIFY row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY _ingested_at DESC) = 1)"
    )


def fold(c: str) -> str:
    return f"strip_accents(lower(rtrim({c})))"


def segment(c: str, n: int) -> str:
    parts = f"string_split({c}, ' - ')"
    if n < 3:
        return f"trim({parts}[{n}])"
    return f"CASE WHEN len({parts}) > 2 THEN trim(array_to_string({parts}[3:], ' - ')) END"


def padded(model: str, given: Mapping[str, str]) -> str:
    """Select list in contract order, NULL where the source has no such column."""
    return ", ".join(
        f"CAST({given.get(c, 'NULL')} AS "
        f"{ {'string': 'VARCHAR', 'timestamp_ntz': 'TIMESTAMP'}.get(column_type(model, c), column_type(model, c)) }) AS {c}"
        for c in COLUMNS[model]
    )


# ---- master data -----------------------------------------------------------

MODEL_SQL["partner"] = f"""
SELECT c.CardCode AS partner_code, lower(c.CardName) AS partner_name,
       {label('c.CardType', codes.PARTNER_TYPE)} AS partner_type,
       c.GroupCode AS group_code, lower(g.GroupName) AS group_name, c.SlpCode AS salesperson_code,
       lower(c.U_franchiseName) AS franchise_name,
       {label('c.U_PRESALE', codes.PRESALE_CHANNEL)} AS presale_channel,
       {label('c.U_PARTNER_SHOW_IN_BI', codes.SIM_NAO)} AS show_in_bi,
       c.LicTradNum AS cpf_cnpj_official,
       CASE WHEN length(trim(regexp_replace(c.Password, '[./-]', '', 'g'))) > 0
            THEN regexp_replace(c.Password, '[./-]', '', 'g') ELSE 'SAP' || c.CardCode END AS cpf_cnpj_normalized,
       CAST(c.CreateDate AS DATE) AS registration_date, CAST(c.UpdateDate AS DATE) AS updated_date
FROM raw_ocrd c LEFT JOIN raw_ocrg g ON c.GroupCode = g.GroupCode"""

MODEL_SQL["item"] = f"""
SELECT o.ItemCode AS item_code, lower(o.ItemName) AS item_name,
       o.U_FAMILY AS family_code, lower(f.Name) AS family_name, o.U_CLASS AS class_code, lower(c.Name) AS class_name,
       o.U_SUB_CLASS AS sub_class_code, lower(s.Name) AS sub_class_name, lower(o.U_CURVE) AS abc_curve,
       lower(o.InvntryUom) AS unit_of_measure, o.SWeight1 AS unit_weight_kg,
       CASE WHEN length(trim(o.U_LEAD_TIME)) = 0 THEN 0 ELSE TRY_CAST(trim(o.U_LEAD_TIME) AS INTEGER) END AS lead_time_days,
       {label('o.InvntItem', codes.YES_NO)} AS is_stockable, {label('o.SellItem', codes.YES_NO)} AS is_sellable,
       {label('o.PrchseItem', codes.YES_NO)} AS is_purchased,
       {label('o.U_MADE_TO_ORDER', codes.MADE_TO_ORDER)} AS is_made_to_order,
       {label('o.validFor', codes.YES_NO)} AS valid_for_use, {label('o.frozenFor', codes.YES_NO)} AS blocked,
       o.FirmCode AS manufacturer_code, lower(m.FirmName) AS manufacturer_name
FROM raw_oitm o
LEFT JOIN raw_item_family f ON f.Code = o.U_FAMILY LEFT JOIN raw_item_class c ON c.Code = o.U_CLASS
LEFT JOIN raw_item_sub_class s ON s.Code = o.U_SUB_CLASS LEFT JOIN raw_omrc m USING (FirmCode)"""

MODEL_SQL["item_price_list"] = """
SELECT ItemCode AS item_code, PriceList AS price_list_number, ListName AS price_list_name, Price AS list_price
FROM raw_itm1 LEFT JOIN raw_opln ON ListNum = PriceList"""

MODEL_SQL["warehouse"] = f"""
SELECT h.WhsCode AS warehouse_code, lower(h.WhsName) AS warehouse_name, h.BPLid AS branch_id,
       lower(b.BPLName) AS branch_name, lower(b.U_NOMENCLATURE) AS branch_nomenclature,
       h.U_STORE AS store_code, lower(s.Name) AS store_name, {label('h.Inactive', codes.YES_NO)} AS inactive
FROM raw_owhs h LEFT JOIN raw_obpl b ON b.BPLId = h.BPLid LEFT JOIN raw_stores s ON s.Code = h.U_STORE"""

MODEL_SQL["user"] = """
SELECT INTERNAL_K AS user_id, USER_CODE AS user_login, lower(U_NAME) AS user_name, Department AS department_id
FROM raw_ousr"""

MODEL_SQL["employee"] = """
SELECT SlpCode AS employee_code, lower(string_split(bare, ' - ')[1]) AS employee_name, SlpName AS sap_full_name,
       CASE WHEN starts_with(folded, 'nao utilizar') THEN 'inactive' ELSE 'active' END AS status
FROM (SELECT *, strip_accents(lower(SlpName)) AS folded,
             CASE WHEN starts_with(strip_accents(lower(SlpName)), 'nao utilizar - ')
                  THEN ltrim(substr(SlpName, 16)) ELSE SlpName END AS bare
      FROM raw_oslp WHERE SlpCode > -1)"""

MODEL_SQL["standardized_store"] = """
SELECT s.Code AS store_code, lower(s.Name) AS old_store_name, lower(x."NOVO") AS new_store_name
FROM raw_stores s LEFT JOIN raw_store_mapping x ON x."ANTIGO" = s.Name"""

MODEL_SQL["goal_rows"] = f"""
SELECT * FROM (
    SELECT 'wholesale' AS channel, * FROM raw_wholesale_goals UNION ALL SELECT 'retail', * FROM raw_retail_goals
) WHERE "Data" >= {day(P.bridge_floor.replace(year=P.goal_min_year))}
    AND "Vendedor" IS NOT NULL AND NOT starts_with("Vendedor", 'FRANQUIA')"""

MODEL_SQL["goal_name_entry"] = f"""
SELECT min(n) AS normalized_name, min(d) AS first_goal
FROM (SELECT lower({segment('"Vendedor"', 1)}) AS n, CAST("Data" AS DATE) AS d FROM m_goal_rows)
GROUP BY {fold('n')}"""

MODEL_SQL["salesperson_bridge"] = f"""
SELECT p.SlpCode AS salesperson_code, p.SlpName AS salesperson_name, p.n AS normalized_name, p.st AS store_code,
       coalesce(s.new_store_name, s.old_store_name) AS store_name, p.store_text, p.role,
       CASE WHEN g.first_goal < {day(P.bridge_floor)} THEN {day(P.bridge_floor)}
            ELSE coalesce(g.first_goal, {day(P.bridge_default)}) END AS valid_from,
       CAST(NULL AS DATE) AS valid_to, 'sap_oslp' AS source
FROM (SELECT *, trim(U_STORE) AS st, lower({segment('SlpName', 1)}) AS n,
             {segment('SlpName', 2)} AS store_text, {segment('SlpName', 3)} AS role
      FROM raw_oslp
      WHERE SlpCode >= 0 AND SlpCode <> 184 AND SlpCode <> 188 AND length(trim(U_STORE)) > 0
        AND NOT starts_with(strip_accents(lower(SlpName)), 'nao utilizar')) p
LEFT JOIN m_standardized_store s ON s.store_code = p.st
LEFT JOIN m_goal_name_entry g ON {fold('g.normalized_name')} = {fold('p.n')}"""

# ---- sales -------------------------------------------------------------------

MODEL_SQL["sales_store_salesperson"] = """
SELECT SlpCode AS salesperson_code, lower(SlpName) AS salesperson_name, U_STORE AS salesperson_store_code,
       lower(Name) AS salesperson_store_name
FROM raw_oslp LEFT JOIN raw_stores ON Code = U_STORE"""

MODEL_SQL["sales_expenses"] = """
SELECT e.document_type, e.DocEntry AS doc_entry, e.LineNum AS line_number, e.ExpnsCode AS expense_code,
       lower(x.ExpnsName) AS expense_name, e.LineTotal AS expense_amount, e._ingested_at
FROM (SELECT 'invoice' AS document_type, * FROM raw_inv3 UNION ALL SELECT 'return', * FROM raw_rin3) e
LEFT JOIN raw_oexd x USING (ExpnsCode)"""

MODEL_SQL["sales_freight_document"] = """
SELECT document_type, doc_entry, sum(CASE WHEN expense_code = 1 THEN expense_amount END) AS freight_amount
FROM m_sales_expenses GROUP BY ALL HAVING count(*) FILTER (expense_code = 1) > 0"""

_SALES = {
    "invoice": ("oinv", "nf", codes.LOAD_KIT, "inv1", "inv12"),
    "quote": ("oqut", "orc", codes.LOAD_KIT_QUOTE, "qut1", "qut12"),
    "return": ("orin", "dev", codes.LOAD_KIT, "rin1", "rin12"),
    "order": ("ordr", "ped", codes.LOAD_KIT, "rdr1", None),
}


def _sales_documents(kind: str) -> str:
    raw, prefix, kit, _, _ = _SALES[kind]
    given = {
        "document_id": f"'{prefix}-' || d.DocEntry", "document_type": f"'{kind}'", "doc_entry": "d.DocEntry",
        "document_number": "d.DocNum", "issue_date": "d.DocDate", "creation_date": "d.CreateDate",
        "updated_date": "d.UpdateDate", "document_status": label("d.DocStatus", codes.DOCUMENT_STATUS),
        "canceled": label("d.CANCELED", codes.CANCELED), "customer_code": "d.CardCode",
        "salesperson_code": "d.SlpCode", "salesperson_name": "v.salesperson_name",
        "salesperson_store_code": "v.salesperson_store_code", "salesperson_store_name": "v.salesperson_store_name",
        "branch_id": "d.BPLId", "branch_name": "lower(b.BPLName)", "branch_nomenclature": "lower(b.U_NOMENCLATURE)",
        "document_total": "d.DocTotal", "gross_profit": "d.GrosProfit", "total_taxes": "d.VatSum",
        "partner_show_in_bi": "p.show_in_bi", "presale_channel": "p.presale_channel", "freight_amount": "0",
        "display_store_name": "v.salesperson_store_name", "_ingested_at": "d._ingested_at",
    }
    for c in ("partner_name", "partner_type", "group_code", "group_name", "franchise_name",
              "cpf_cnpj_official", "cpf_cnpj_normalized"):
        given[c] = f"p.{c}"
    joins = ""
    if kind != "order":
        given |= {
            "series_code": "d.SeqCode", "payment_method": "lower(d.PeyMethod)", "header_discount": "d.DiscSum",
            "load_kit": label("d.U_LOAD_KIT", kit), "store_code": "d.U_Store",
            "document_store_name": "lower(s.Name)",
            "display_store_name": "coalesce(lower(s.Name), v.salesperson_store_name)",
        }
        joins = "LEFT JOIN raw_stores s ON s.Code = d.U_Store"
    else:
        given["expected_delivery_date"] = "d.DocDueDate"
    if kind in ("invoice", "return"):
        given |= {
            "series_number": "d.Serial", "store_code": "s.Code",
            "presale_channel": f"coalesce({label('d.U_PRESALE', codes.PRESALE_CHANNEL)}, p.presale_channel)",
            "finance_validated": label("d.U_FINANCE_VALIDATED", codes.FINANCE_VALIDATED),
            "document_show_in_bi": label("d.U_SHOW_IN_BI", codes.SIM_NAO),
            "freight_amount": "coalesce(fr.freight_amount, 0)",
        }
        joins = (
            "LEFT JOIN raw_stores s ON d.U_Store IN (s.Code, s.Name) "
            f"LEFT JOIN (SELECT * FROM m_sales_freight_document WHERE document_type = '{kind}') fr "
            "ON fr.doc_entry = d.DocEntry"
        )
    if kind == "invoice":
        given |= {
            "accrual_date": "d.TaxDate", "ledger_transaction_id": "d.TransId",
            "triangulation": label("d.U_TRIANGULATION", codes.TRIANGULATION),
        }
    return (
        f"SELECT {padded('sales_invoice_documents', given)}\nFROM {newest('raw_' + raw, 'DocEntry')} d\n"
        "LEFT JOIN m_partner p ON p.partner_code = d.CardCode\n"
        "LEFT JOIN m_sales_store_salesperson v ON v.salesperson_code = d.SlpCode\n"
        f"LEFT JOIN raw_obpl b ON b.BPLId = d.BPLId {joins}"
    )


_ITEM = (
    "item_name", "family_code", "family_name", "class_code", "class_name", "sub_class_code",
    "sub_class_name", "abc_curve", "unit_of_measure", "manufacturer_code",
)


def ptbr(c: str, kind: str) -> str:
    return (
        f"TRY_CAST(CASE WHEN instr({c}, ',') > 0 THEN replace(replace({c}, '.', ''), ',', '.') "
        f"ELSE {c} END AS {kind})"
    )


def _sales_lines(kind: str) -> str:
    _, _, _, raw, usage = _SALES[kind]
    given = {
        "document_type": f"'{kind}'", "doc_entry": "l.DocEntry", "line_number": "l.LineNum", "item_code": "l.ItemCode",
        "item_description": "lower(l.Dscription)", "quantity": "l.Quantity", "unit_price": "l.Price",
        "line_total": "l.LineTotal", "line_status": "l.LineStatus", "warehouse_code": "l.WhsCode",
        "source_doc_entry": "l.BaseEntry", "source_document_type": "l.BaseType", "_ingested_at": "l._ingested_at",
    } | {c: f"i.{c}" for c in _ITEM}
    joins = "LEFT JOIN m_item i ON i.item_code = l.ItemCode"
    if usage:
        given |= {
            "price_before_discount": "l.PriceBefDi", "discount_percentage": "l.DiscPrcnt", "total_taxes": "l.VatSum",
            "inventory_cost_price": "l.INMPrice", "usage_id": "l.Usage", "cfop": "lower(l.CFOPCode)",
            "bdi_price": ptbr("l.U_BDI_PRICE", "DECIMAL(18,2)"), "cost_price": ptbr("l.U_COST_PRICE", "DECIMAL(18,2)"),
            "margin": ptbr("l.U_MARGIN", "DECIMAL(18,4)"), "main_usage_id": "u.main_usage_id",
            "main_usage_description": "u.main_usage_description",
        }
        joins += f" LEFT JOIN m_sales_fiscal_usage_{kind} u ON u.doc_entry = l.DocEntry"
    else:
        given |= {
            "open_quantity": "l.OpenQty", "source_line_number": "l.BaseLine", "doc_entry_sales_invoice": "l.TrgetEntry",
        }
    if kind == "return":
        given["effective_source_doc_entry"] = "l.ActBaseEnt"
    return f"SELECT {padded('sales_invoice_lines', given)}\nFROM raw_{raw} l {joins}"


def _usage(raw: str) -> str:
    return (
        "SELECT h.DocEntry AS doc_entry, h.MainUsage AS main_usage_id, lower(g.Usage) AS main_usage_description "
        f"FROM raw_{raw} h LEFT JOIN raw_ousg g ON g.ID = h.MainUsage"
    )


for _kind, (_, _, _, _raw, _usage_raw) in _SALES.items():
    MODEL_SQL[f"sales_{_kind}_documents"] = _sales_documents(_kind)
    MODEL_SQL[f"sales_{_kind}_lines"] = _sales_lines(_kind)
    if _usage_raw:
        MODEL_SQL[f"sales_fiscal_usage_{_kind}"] = _usage(_usage_raw)
        MODEL_SQL[f"sales_prices_{_kind}"] = (
            "SELECT DocEntry AS doc_entry, LineNum AS line_number, DocEntry || '/' || LineNum AS line_key, "
            f"{ptbr('U_BDI_PRICE', 'DECIMAL(18,2)')} AS bdi_price, {ptbr('U_COST_PRICE', 'DECIMAL(18,2)')} AS cost_price "
            f"FROM raw_{_raw}"
        )

for _part in ("documents", "lines"):
    MODEL_SQL[f"sales_fiscal_{_part}"] = " UNION ALL ".join(f"SELECT * FROM m_sales_{k}_{_part}" for k in _SALES)

MODEL_SQL["sales_delivery_documents"] = f"""
SELECT d.DocEntry AS doc_entry, d.DocNum AS delivery_number, CAST(d.DocDate AS DATE) AS issue_date,
       CAST(d.CreateDate AS DATE) AS creation_date, CAST(d.UpdateDate AS DATE) AS updated_date,
       {label('d.DocStatus', codes.DOCUMENT_STATUS)} AS document_status, {label('d.CANCELED', codes.CANCELED)} AS canceled,
       d.CardCode AS customer_code, p.partner_name, p.group_code, p.group_name, p.franchise_name, p.cpf_cnpj_official,
       p.cpf_cnpj_normalized, p.show_in_bi AS partner_show_in_bi, d.BPLId AS branch_id, lower(b.BPLName) AS branch_name,
       lower(b.U_NOMENCLATURE) AS branch_nomenclature, d._ingested_at
FROM {newest('raw_odln', 'DocEntry')} d LEFT JOIN m_partner p ON p.partner_code = d.CardCode
LEFT JOIN raw_obpl b ON b.BPLId = d.BPLId"""

MODEL_SQL["sales_delivery_lines"] = f"""
SELECT l.DocEntry AS doc_entry, l.LineNum AS line_number, l.ItemCode AS item_code, l.WhsCode AS warehouse_code,
       l.Quantity AS quantity, l.LineStatus AS line_status, l.BaseEntry AS source_doc_entry,
       l.BaseLine AS source_line_number, l.BaseType AS source_document_type,
       {', '.join('i.' + c for c in _ITEM)}, l._ingested_at
FROM raw_dln1 l LEFT JOIN m_item i ON i.item_code = l.ItemCode"""

MODEL_SQL["sales_installments"] = f"""
SELECT DocEntry AS doc_entry, InstlmntID AS installment_number, CAST(DueDate AS DATE) AS due_date,
       InsTotal AS installment_amount, Paid AS paid_amount, InsTotal - Paid AS open_balance,
       {label('Status', codes.INSTALLMENT_STATUS)} AS installment_status, _ingested_at
FROM raw_inv6"""

MODEL_SQL["sales_goals"] = f"""
SELECT channel, date, original_goal_salesperson, original_goal_store, daily_goal, g.normalized_name, goal_store_text,
       b.salesperson_code, b.salesperson_name, s.store_code AS goal_store_code, s.new_store_name AS goal_store_name,
       b.source AS bridge_source
FROM (SELECT channel, CAST("Data" AS DATE) AS date, "Vendedor" AS original_goal_salesperson,
             "Loja" AS original_goal_store, "Meta Diária" AS daily_goal,
             lower({segment('"Vendedor"', 1)}) AS normalized_name, {segment('"Vendedor"', 2)} AS goal_store_text
      FROM m_goal_rows
      QUALIFY row_number() OVER (PARTITION BY channel, CAST("Data" AS DATE), "Vendedor", "Loja"
                                 ORDER BY _ingested_at DESC, "Ordem Vendedor" DESC) = 1) g
LEFT JOIN m_standardized_store s
    ON s.old_store_name = CASE WHEN lower(trim(g.original_goal_store)) = 'bonsucesso - rj' THEN 'bonsucesso' ELSE lower(trim(g.original_goal_store)) END
LEFT JOIN m_salesperson_bridge b
    ON {fold('b.normalized_name')} = {fold('g.normalized_name')}
    AND g.date BETWEEN b.valid_from AND coalesce(b.valid_to, DATE '9999-12-31')
QUALIFY row_number() OVER (
    PARTITION BY channel, date, original_goal_salesperson, original_goal_store
    ORDER BY CASE WHEN b.store_code = s.store_code THEN 0 ELSE 1 END, b.valid_from DESC NULLS LAST,
             b.salesperson_code, s.store_code) = 1"""

# ---- purchases ---------------------------------------------------------------

_PURCHASES = {"invoice": ("opch", "nf", "pch1"), "order": ("opor", "ped", "por1"), "requisition": ("oprq", "req", "prq1")}


def _purchase_documents(kind: str) -> str:
    raw, prefix, _ = _PURCHASES[kind]
    given = {
        "document_id": f"'{prefix}-' || d.DocEntry", "document_type": f"'{kind}'", "doc_entry": "d.DocEntry",
        "document_number": "d.DocNum", "issue_date": "d.DocDate", "updated_date": "d.UpdateDate",
        "document_status": label("d.DocStatus", codes.DOCUMENT_STATUS), "canceled": label("d.CANCELED", codes.CANCELED),
        "branch_id": "d.BPLId", "branch_name": "lower(b.BPLName)", "branch_nomenclature": "lower(b.U_NOMENCLATURE)",
        "_ingested_at": "d._ingested_at",
    }
    joins = ["LEFT JOIN raw_obpl b ON b.BPLId = d.BPLId"]
    if kind != "requisition":
        given |= {
            "supplier_code": "d.CardCode", "supplier_name": "p.partner_name", "partner_show_in_bi": "p.show_in_bi",
            "document_total": "d.DocTotal",
        } | {c: f"p.{c}" for c in ("group_code", "group_name", "cpf_cnpj_official", "cpf_cnpj_normalized")}
        joins.append("LEFT JOIN m_partner p ON p.partner_code = d.CardCode")
    else:
        given |= {"external_ticket": "d.U_externalTicket", "external_ticket_date": "d.U_externalTicketDate"}
    if kind != "invoice":
        given |= {
            "creation_date": "d.CreateDate", "user_id": "d.UserSign", "user_login": "u.USER_CODE",
            "user_name": "lower(u.U_NAME)",
        }
        joins.append("LEFT JOIN raw_ousr u ON u.INTERNAL_K = d.UserSign")
    else:
        given |= {
            "accrual_date": "d.TaxDate", "due_date": "d.DocDueDate", "series_code": "d.SeqCode",
            "series_number": "d.Serial", "payment_method": "lower(d.PeyMethod)", "ledger_transaction_id": "d.TransId",
            "store_code": "d.U_Store", "store_name": "lower(s.Name)", "total_taxes": "d.VatSum",
            "gross_profit": "d.GrosProfit",
        }
        joins.append("LEFT JOIN raw_stores s ON s.Code = d.U_Store")
    return (
        f"SELECT {padded('purchases_invoice_documents', given)}\nFROM {newest('raw_' + raw, 'DocEntry')} d "
        + " ".join(joins)
    )


def _purchase_lines(kind: str) -> str:
    raw = _PURCHASES[kind][2]
    given = {
        "document_type": f"'{kind}'", "doc_entry": "l.DocEntry", "line_number": "l.LineNum", "item_code": "l.ItemCode",
        "warehouse_code": "l.WhsCode", "quantity": "l.Quantity", "_ingested_at": "l._ingested_at",
    } | {c: f"i.{c}" for c in _ITEM}
    joins = "LEFT JOIN m_item i ON i.item_code = l.ItemCode"
    if kind != "requisition":
        given |= {
            "unit_price": "l.Price", "line_total": "l.LineTotal", "source_doc_entry": "l.BaseEntry",
            "source_document_type": "l.BaseType",
        }
    if kind == "invoice":
        given |= {
            "price_before_discount": "l.PriceBefDi", "discount_percentage": "l.DiscPrcnt", "total_taxes": "l.VatSum",
            "inventory_cost_price": "l.INMPrice", "ledger_account": "l.AcctCode", "usage_id": "l.Usage",
            "main_usage_id": "u.main_usage_id", "main_usage_description": "u.main_usage_description",
        }
        joins += " LEFT JOIN m_purchases_fiscal_usage_invoice u ON u.doc_entry = l.DocEntry"
    else:
        given |= {"open_quantity": "l.OpenQty", "line_status": "l.LineStatus"}
    return f"SELECT {padded('purchases_invoice_lines', given)}\nFROM raw_{raw} l {joins}"


MODEL_SQL["purchases_fiscal_usage_invoice"] = _usage("pch12")
for _kind in _PURCHASES:
    MODEL_SQL[f"purchases_{_kind}_documents"] = _purchase_documents(_kind)
    MODEL_SQL[f"purchases_{_kind}_lines"] = _purchase_lines(_kind)
for _part in ("documents", "lines"):
    MODEL_SQL[f"purchases_fiscal_{_part}"] = " UNION ALL ".join(
        f"SELECT * FROM m_purchases_{k}_{_part}" for k in _PURCHASES
    )

# ---- finance and inventory -----------------------------------------------------

MODEL_SQL["finance_journal_entries"] = f"""
SELECT l.TransId AS transaction_id, l.Line_ID AS line_number, CAST(h.RefDate AS DATE) AS reference_date,
       h.TransType AS transaction_type, lower(h.Memo) AS historical, h.BaseRef AS document_reference,
       l.Account AS ledger_account, lower(a.AcctName) AS account_name, l.ContraAct AS offset_account,
       lower(o.AcctName) AS offset_account_name, l.Debit AS debit, l.Credit AS credit, l.ShortName AS partner_code,
       p.partner_name, p.partner_type, p.group_code, p.group_name, l._ingested_at
FROM {newest('raw_jdt1', 'TransId', 'Line_ID')} l
LEFT JOIN {newest('raw_ojdt', 'TransId')} h ON h.TransId = l.TransId
LEFT JOIN raw_oact a ON a.AcctCode = l.Account LEFT JOIN raw_oact o ON o.AcctCode = l.ContraAct
LEFT JOIN m_partner p ON p.partner_code = l.ShortName"""

MODEL_SQL["finance_payments"] = f"""
SELECT y.DocEntry AS doc_entry, y.DocNum AS payment_number, {label('y.DocType', codes.PAYMENT_TYPE)} AS payment_type,
       CAST(y.DocDate AS DATE) AS payment_date, CAST(y.TaxDate AS DATE) AS accrual_date,
       CAST(y.DocDueDate AS DATE) AS due_date, CAST(y.UpdateDate AS DATE) AS updated_date,
       {label('y.Canceled', codes.CANCELED)} AS canceled, y.CardCode AS partner_code, p.partner_name, p.partner_type,
       p.group_code, p.group_name, p.cpf_cnpj_official, p.cpf_cnpj_normalized, y.BPLId AS branch_id,
       lower(b.BPLName) AS branch_name, lower(b.U_NOMENCLATURE) AS branch_nomenclature, y.DocTotal AS payment_total,
       y.DocCurr AS currency, y.CashSum AS cash_amount, y.TrsfrSum AS transfer_amount, y.CheckSum AS check_amount,
       y.CreditSum AS credit_amount, y.NoDocSum AS amount_without_document, y.TransId AS ledger_transaction_id,
       lower(y.JrnlMemo) AS historical, y._ingested_at
FROM {newest('raw_ovpm', 'DocEntry')} y LEFT JOIN m_partner p ON p.partner_code = y.CardCode
LEFT JOIN raw_obpl b ON b.BPLId = y.BPLId"""

_HIERARCHY = ", ".join("i." + c for c in _ITEM if c != "manufacturer_code")
_PLACE = "h.warehouse_name, h.branch_id, h.branch_name, h.store_code, h.store_name"

MODEL_SQL["current_inventory"] = f"""
SELECT s.ItemCode AS item_code, s.WhsCode AS warehouse_code, s.OnHand AS inventory_quantity,
       s.IsCommited AS committed_quantity, s.OnOrder AS ordered_quantity, s.AvgPrice AS average_cost_price,
       {_HIERARCHY}, {_PLACE}, h.inactive AS warehouse_inactive
FROM raw_oitw s JOIN m_item i ON i.item_code = s.ItemCode JOIN m_warehouse h ON h.warehouse_code = s.WhsCode"""

_SLUG = " ".join(f"WHEN {k} THEN '{v}'" for k, v in codes.MOVEMENT_TYPE.items())

MODEL_SQL["inventory_movements"] = f"""
SELECT m.TransNum AS transaction_number, CAST(m.DocDate AS DATE) AS movement_date, m.ItemCode AS item_code,
       m.Warehouse AS warehouse_code, m.InQty AS inflow_quantity, m.OutQty AS outflow_quantity,
       m.InQty - m.OutQty AS movement_quantity, m.TransValue AS transaction_amount,
       m.CalcPrice AS calculated_average_price, m.Balance AS inventory_value_after_movement,
       CASE WHEN m.CalcPrice > 0 THEN CAST(m.Balance / m.CalcPrice AS DECIMAL(20,6)) END AS quantity_after_movement,
       CASE WHEN m.OutQty = 0 AND m.InQty > 0 THEN 'inflow' WHEN m.InQty = 0 AND m.OutQty > 0 THEN 'outflow'
            WHEN m.InQty = 0 AND m.OutQty = 0 THEN 'value_adjustment' ELSE 'mixed' END AS movement_direction,
       m.TransType AS transaction_type,
       CASE m.TransType {_SLUG} ELSE 'type_' || m.TransType END AS transaction_type_description,
       m.CreatedBy AS source_doc_entry, m.BASE_REF AS source_document_number, m.DocLineNum AS source_line_number,
       {_HIERARCHY}, i.is_stockable, {_PLACE}, m._ingested_at
FROM raw_oinm m LEFT JOIN m_item i ON i.item_code = m.ItemCode
LEFT JOIN m_warehouse h ON h.warehouse_code = m.Warehouse"""

# ---- marts -----------------------------------------------------------------------

MODEL_SQL["dim_date"] = """
SELECT date, quarter(date) AS quarter, month(date) AS month, dayofweek(date) + 1 AS day_of_week,
       CASE WHEN dayofweek(date) IN (0, 6) THEN 'yes' ELSE 'no' END AS weekend
FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS date)"""

MODEL_SQL["dim_item"] = """
SELECT *, CASE WHEN is_sellable = 'yes' AND is_stockable = 'yes' THEN 'product'
               WHEN is_sellable = 'yes' AND is_stockable = 'no' THEN 'service'
               WHEN is_sellable = 'no' AND is_purchased = 'yes' THEN 'administrative purchase'
               ELSE 'others' END AS item_type,
       left(item_code, 2) AS code_prefix,
       CASE left(item_code, 2) WHEN 'SV' THEN 'service' WHEN 'DA' THEN 'administrative expense'
            ELSE 'product' END AS category_code
FROM m_item"""

MODEL_SQL["dim_partner"] = """
SELECT *, CASE WHEN starts_with(cpf_cnpj_normalized, 'SAP') THEN 'no document'
               WHEN length(rtrim(cpf_cnpj_normalized)) = 11 THEN 'cpf' WHEN length(rtrim(cpf_cnpj_normalized)) = 14 THEN 'cnpj'
               ELSE 'irregular' END AS cpf_cnpj_type
FROM m_partner"""

MODEL_SQL["dim_employees"] = f"""
SELECT e.*, (SELECT min(b.valid_from) FROM m_salesperson_bridge b
             WHERE {fold('b.normalized_name')} = {fold('e.employee_name')}) AS hire_date
FROM m_employee e"""

MODEL_SQL["dim_store"] = """
SELECT store_code, coalesce(new_store_name, old_store_name) AS store_name FROM m_standardized_store"""

MODEL_SQL["dim_warehouse"] = """
SELECT w.warehouse_code, w.warehouse_name, w.branch_id, w.branch_name, w.branch_nomenclature, w.store_code, s.store_name
FROM m_warehouse w LEFT JOIN m_dim_store s USING (store_code)"""

MODEL_SQL["fact_sales"] = """
SELECT document_id, l.document_type, l.doc_entry, l.line_number, document_number, creation_date AS date, l.item_code,
       customer_code AS partner_code, nullif(salesperson_code, -1) AS employee_code, d.store_code, l.warehouse_code,
       l.usage_id, l.main_usage_id, l.main_usage_description, l.cfop, d.presale_channel, d.load_kit, d.canceled,
       sgn * l.quantity AS quantity, sgn * l.line_total AS line_total, sgn * l.total_taxes AS total_taxes,
       sgn * (l.quantity * l.inventory_cost_price) AS total_cost,
       sgn * (l.line_total - l.quantity * l.inventory_cost_price) AS gross_profit,
       l.unit_price, l.price_before_discount, l.discount_percentage, l.inventory_cost_price, l.bdi_price, l.cost_price,
       l.margin AS sap_margin
FROM m_sales_fiscal_lines l
JOIN (SELECT *, CASE WHEN document_type = 'return' AND canceled = 'reversal' THEN 1
                     WHEN document_type = 'return' OR canceled = 'reversal' THEN -1 ELSE 1 END AS sgn
      FROM m_sales_fiscal_documents WHERE document_type IN ('invoice', 'return')) d
  ON d.document_type = l.document_type AND d.doc_entry = l.doc_entry
WHERE d.document_show_in_bi = 'yes'
   OR (d.partner_show_in_bi = 'yes' AND (d.group_code <> 111 OR d.branch_id = 9)
       AND CASE l.document_type WHEN 'invoice' THEN l.usage_id IN (9, 10, 20, 22, 37, 46, 56)
                ELSE l.main_usage_id = 24 AND d.canceled = 'no' END)"""

MODEL_SQL["fact_goals"] = f"""
SELECT * EXCLUDE (daily_goal, salesperson_code), salesperson_code AS employee_code, coalesce(daily_goal, 0) AS daily_goal
FROM m_sales_goals WHERE date >= DATE '{P.goal_mart_min_year}-01-01' AND salesperson_code IS NOT NULL"""

MODEL_SQL["fact_purchases"] = """
SELECT d.*, l.*, d.supplier_code AS partner_code, l.quantity * l.inventory_cost_price AS total_cost
FROM (SELECT * EXCLUDE (document_type, _ingested_at, total_taxes) FROM m_purchases_invoice_documents) d
JOIN (SELECT * RENAME (doc_entry AS line_doc) FROM m_purchases_invoice_lines) l ON l.line_doc = d.doc_entry
WHERE l.usage_id = 3 AND d.canceled = 'no' AND d.partner_show_in_bi = 'yes' AND d.group_code <> 111"""

MODEL_SQL["fact_accounts_receivable"] = """
SELECT d.document_type, d.doc_entry, d.document_number, d.creation_date AS date, d.customer_code AS partner_code,
       nullif(d.salesperson_code, -1) AS employee_code, d.store_code, i.first_due_date, i.last_due_date, d.load_kit,
       d.presale_channel, i.total_amount, i.paid_amount, i.total_amount - i.paid_amount AS open_balance,
       i.installment_count, i.paid_installment_count, i.open_installment_count, i.partial_installment_count,
       CASE WHEN i.paid_amount >= i.total_amount THEN 'paid' WHEN i.paid_amount > 0 THEN 'partial'
            ELSE 'open' END AS payment_status
FROM m_sales_invoice_documents d
JOIN (SELECT doc_entry, min(due_date) AS first_due_date, max(due_date) AS last_due_date,
             sum(installment_amount) AS total_amount, sum(paid_amount) AS paid_amount, count(*) AS installment_count,
             count(*) FILTER (paid_amount >= installment_amount) AS paid_installment_count,
             count(*) FILTER (paid_amount = 0) AS open_installment_count,
             count(*) FILTER (paid_amount > 0 AND paid_amount < installment_amount) AS partial_installment_count
      FROM m_sales_installments GROUP BY doc_entry) i ON i.doc_entry = d.doc_entry
WHERE EXISTS (SELECT 1 FROM m_sales_invoice_lines l WHERE l.doc_entry = d.doc_entry
              AND (d.document_show_in_bi = 'yes'
                   OR (l.usage_id IN (9, 10, 20, 22, 37, 46, 56) AND d.partner_show_in_bi = 'yes'
                       AND (d.group_code <> 111 OR d.branch_id = 9))))"""

_SINCE = {"30d": 30, "45d": 45, "60d": 60}
_YTD_DAYS = (P.as_of - P.as_of.replace(month=1, day=1)).days + 1
_WINDOWS = {k: f"{day(P.as_of)} - {n}" for k, n in _SINCE.items()} | {"ytd": day(P.as_of.replace(month=1, day=1))}
_LENGTHS = _SINCE | {"ytd": _YTD_DAYS}

MODEL_SQL["fact_inventory"] = f"""
SELECT s.* EXCLUDE (average_cost_price, warehouse_inactive), p.list_price,
       s.inventory_quantity * p.list_price AS inventory_value_at_list_price,
       {', '.join(f'coalesce(o.out_{k}, 0) AS outflow_quantity_{k}' for k in _WINDOWS)},
       {', '.join(f'CASE WHEN s.inventory_quantity > 0 THEN coalesce(o.out_{k}, 0) / s.inventory_quantity END AS turnover_{k}' for k in _WINDOWS)},
       {', '.join(f'CASE WHEN o.out_{k} > 0 THEN s.inventory_quantity * {n} / o.out_{k} END AS coverage_days_{k}' for k, n in _LENGTHS.items())},
       o.last_outflow_date, {day(P.as_of)} - o.last_outflow_date AS days_without_outflow
FROM m_current_inventory s
LEFT JOIN m_item_price_list p ON p.item_code = s.item_code AND p.price_list_number = {P.price_list}
LEFT JOIN (SELECT item_code, warehouse_code,
                  {', '.join(f'coalesce(sum(outflow_quantity) FILTER (movement_date >= {since}), 0) AS out_{k}' for k, since in _WINDOWS.items())},
                  max(movement_date) FILTER (outflow_quantity > 0) AS last_outflow_date
           FROM m_inventory_movements WHERE movement_date < {day(P.as_of)} GROUP BY item_code, warehouse_code) o
  ON o.item_code = s.item_code AND o.warehouse_code = s.warehouse_code
WHERE s.warehouse_inactive <> 'yes'"""

MODEL_SQL["fact_daily_inventory_movement"] = f"""
SELECT * RENAME (movement_date AS date) FROM (
    SELECT m.* EXCLUDE (inflow_quantity, outflow_quantity, movement_quantity),
           sum(inflow_quantity) OVER per_day AS inflow_quantity, sum(outflow_quantity) OVER per_day AS outflow_quantity,
           sum(movement_quantity) OVER per_day AS movement_quantity,
           sum(transaction_amount) OVER per_day AS transacted_amount, count(*) OVER per_day AS movement_count,
           row_number() OVER (PARTITION BY item_code, warehouse_code, movement_date
                              ORDER BY transaction_number DESC) AS rn
    FROM m_inventory_movements m WHERE movement_date < {day(P.as_of)}
    WINDOW per_day AS (PARTITION BY item_code, warehouse_code, movement_date)
) WHERE rn = 1"""
