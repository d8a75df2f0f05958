"""Staging: one rename-and-cast projection per raw table.

A line reads `RawColumn -> name` or `RawColumn -> name : rule`, where the rule
is a Spark type to cast to or one of the cleaning rules below.  The load stamp
passes through.  Staging stays a lazy projection, so column pruning and
filters reach the scan of the raw table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import clean_notes, ptbr_decimal, zero_pad_postal

STAMP = "_ingested_at"

_CLEANING: dict[str, Callable[[Column], Column]] = {
    "notes": clean_notes,
    "ptbr2": lambda c: ptbr_decimal(c, 18, 2),
    "ptbr4": lambda c: ptbr_decimal(c, 18, 4),
    "postal": zero_pad_postal,
}

# fixed values: staging name -> (raw table, column mapping)
STAGING: dict[str, tuple[str, str]] = {
    "delivery_lines_dln1": (
        "dln1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        WhsCode -> warehouse_code
        Quantity -> quantity : decimal(20,6)
        LineStatus -> line_status
        BaseEntry -> source_doc_entry
        BaseLine -> source_line_number
        BaseType -> source_document_type
        """,
    ),
    "delivery_odln": (
        "odln",
        """
        DocEntry -> doc_entry
        DocNum -> delivery_number
        DocDate -> issue_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> customer_code
        CardName -> customer_name
        BPLId -> branch_id
        """,
    ),
    "quote_lines_qut1": (
        "qut1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        Dscription -> item_description
        Quantity -> quantity : decimal(20,6)
        Price -> unit_price : decimal(20,6)
        PriceBefDi -> price_before_discount : decimal(20,6)
        DiscPrcnt -> discount_percentage : decimal(18,4)
        LineTotal -> line_total : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        INMPrice -> inventory_cost_price : decimal(20,6)
        LineStatus -> line_status
        Usage -> usage_id : int
        CFOPCode -> cfop
        WhsCode -> warehouse_code
        BaseEntry -> source_doc_entry
        BaseType -> source_document_type
        U_BDI_PRICE -> bdi_price : ptbr2
        U_COST_PRICE -> cost_price : ptbr2
        U_MARGIN -> margin : ptbr4
        """,
    ),
    "quote_oqut": (
        "oqut",
        """
        DocEntry -> doc_entry
        DocNum -> quote_number
        DocDate -> issue_date : date
        DocDueDate -> expiration_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> customer_code
        CardName -> customer_name
        SlpCode -> salesperson_code
        BPLId -> branch_id
        SeqCode -> series_code
        PeyMethod -> payment_method
        DocTotal -> document_total : decimal(20,6)
        DocTotalSy -> document_total_system_currency : decimal(20,6)
        GrosProfit -> gross_profit : decimal(20,6)
        DiscSum -> header_discount : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        U_LOAD_KIT -> load_kit
        U_Store -> store_code
        """,
    ),
    "quote_usage_qut12": (
        "qut12",
        """
        DocEntry -> doc_entry
        MainUsage -> main_usage
        """,
    ),
    "sales_invoice_expenses_inv3": (
        "inv3",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ExpnsCode -> expense_code
        LineTotal -> expense_amount : decimal(20,6)
        """,
    ),
    "sales_invoice_installments_inv6": (
        "inv6",
        """
        DocEntry -> doc_entry
        InstlmntID -> installment_number
        DueDate -> due_date : date
        InsTotal -> installment_amount : decimal(20,6)
        Paid -> paid_amount : decimal(20,6)
        Status -> installment_status
        """,
    ),
    "sales_invoice_lines_inv1": (
        "inv1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        Dscription -> item_description
        Quantity -> quantity : decimal(20,6)
        Price -> unit_price : decimal(20,6)
        PriceBefDi -> price_before_discount : decimal(20,6)
        DiscPrcnt -> discount_percentage : decimal(18,4)
        LineTotal -> line_total : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        INMPrice -> inventory_cost_price : decimal(20,6)
        LineStatus -> line_status
        Usage -> usage_id : int
        CFOPCode -> cfop
        WhsCode -> warehouse_code
        BaseEntry -> source_doc_entry
        BaseType -> source_document_type
        U_BDI_PRICE -> bdi_price : ptbr2
        U_COST_PRICE -> cost_price : ptbr2
        U_MARGIN -> margin : ptbr4
        """,
    ),
    "sales_invoice_oinv": (
        "oinv",
        """
        DocEntry -> doc_entry
        DocNum -> invoice_number
        DocDate -> issue_date : date
        DocDueDate -> due_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> customer_code
        CardName -> customer_name
        SlpCode -> salesperson_code
        BPLId -> branch_id
        BPLName -> branch_name
        SeqCode -> series_code
        Serial -> series_number
        PeyMethod -> payment_method
        TransId -> ledger_transaction_id
        TaxDate -> accrual_date : date
        DocTotal -> document_total : decimal(20,6)
        DocTotalSy -> document_total_system_currency : decimal(20,6)
        GrosProfit -> gross_profit : decimal(20,6)
        DiscSum -> header_discount : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        NfeValue -> nfe_amount : decimal(20,6)
        DpmAmnt -> advance_payment : decimal(20,6)
        PaidSys -> paid_amount : decimal(20,6)
        isIns -> sales_type
        UpdInvnt -> updates_inventory
        Comments -> notes : notes
        U_externalTicket -> external_ticket
        U_externalTicketDate -> external_ticket_date : date
        U_LOAD_KIT -> load_kit
        U_Store -> store_code
        U_PRESALE -> presale_channel
        U_PROTEST -> in_protest
        U_FINANCE_VALIDATED -> finance_validated
        U_SHOW_IN_BI -> show_in_bi
        U_TRIANGULATION -> triangulation
        """,
    ),
    "sales_invoice_usage_inv12": (
        "inv12",
        """
        DocEntry -> doc_entry
        MainUsage -> main_usage
        """,
    ),
    "sales_order_lines_rdr1": (
        "rdr1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        Dscription -> item_description
        Quantity -> quantity : decimal(20,6)
        Price -> unit_price : decimal(20,6)
        LineTotal -> line_total : decimal(20,6)
        WhsCode -> warehouse_code
        LineStatus -> line_status
        OpenQty -> open_quantity : decimal(20,6)
        BaseEntry -> source_doc_entry
        BaseLine -> source_line_number
        BaseType -> source_document_type
        TrgetEntry -> doc_entry_sales_invoice
        """,
    ),
    "sales_order_ordr": (
        "ordr",
        """
        DocEntry -> doc_entry
        DocNum -> order_number
        DocDate -> issue_date : date
        DocDueDate -> expected_delivery_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> customer_code
        CardName -> customer_name
        SlpCode -> salesperson_code
        BPLId -> branch_id
        DocTotal -> document_total : decimal(20,6)
        GrosProfit -> gross_profit : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        """,
    ),
    "sales_return_expenses_rin3": (
        "rin3",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ExpnsCode -> expense_code
        LineTotal -> expense_amount : decimal(20,6)
        """,
    ),
    "sales_return_lines_rin1": (
        "rin1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        Dscription -> item_description
        Quantity -> quantity : decimal(20,6)
        Price -> unit_price : decimal(20,6)
        PriceBefDi -> price_before_discount : decimal(20,6)
        DiscPrcnt -> discount_percentage : decimal(18,4)
        LineTotal -> line_total : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        INMPrice -> inventory_cost_price : decimal(20,6)
        LineStatus -> line_status
        Usage -> usage_id : int
        CFOPCode -> cfop
        WhsCode -> warehouse_code
        BaseEntry -> source_doc_entry
        BaseType -> source_document_type
        U_BDI_PRICE -> bdi_price : ptbr2
        U_COST_PRICE -> cost_price : ptbr2
        U_MARGIN -> margin : ptbr4
        ActBaseEnt -> effective_source_doc_entry
        """,
    ),
    "sales_return_orin": (
        "orin",
        """
        DocEntry -> doc_entry
        DocNum -> return_number
        DocDate -> issue_date : date
        DocDueDate -> due_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> customer_code
        CardName -> customer_name
        SlpCode -> salesperson_code
        BPLId -> branch_id
        SeqCode -> series_code
        PeyMethod -> payment_method
        DocTotal -> document_total : decimal(20,6)
        DocTotalSy -> document_total_system_currency : decimal(20,6)
        GrosProfit -> gross_profit : decimal(20,6)
        DiscSum -> header_discount : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        U_LOAD_KIT -> load_kit
        U_Store -> store_code
        U_PRESALE -> presale_channel
        U_FINANCE_VALIDATED -> finance_validated
        U_externalTicketDate -> external_ticket_date : date
        Serial -> series_number
        U_externalTicket -> external_ticket
        U_SHOW_IN_BI -> show_in_bi
        """,
    ),
    "sales_return_reference_rin21": (
        "rin21",
        """
        DocEntry -> doc_entry
        """,
    ),
    "sales_return_usage_rin12": (
        "rin12",
        """
        DocEntry -> doc_entry
        MainUsage -> main_usage
        """,
    ),
    "purchase_invoice_installments_pch6": (
        "pch6",
        """
        DocEntry -> doc_entry
        InstlmntID -> installment_number
        DueDate -> due_date : date
        InsTotal -> installment_amount : decimal(20,6)
        Paid -> paid_amount : decimal(20,6)
        Status -> installment_status
        """,
    ),
    "purchase_invoice_lines_pch1": (
        "pch1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        WhsCode -> warehouse_code
        AcctCode -> ledger_account
        Usage -> usage_id : int
        Quantity -> quantity : decimal(20,6)
        Price -> unit_price : decimal(20,6)
        PriceBefDi -> price_before_discount : decimal(20,6)
        DiscPrcnt -> discount_percentage : decimal(18,4)
        LineTotal -> line_total : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        INMPrice -> inventory_cost_price : decimal(20,6)
        BaseEntry -> source_doc_entry
        BaseType -> source_document_type
        """,
    ),
    "purchase_invoice_opch": (
        "opch",
        """
        DocEntry -> doc_entry
        DocNum -> invoice_number
        DocDate -> issue_date : date
        DocDueDate -> due_date : date
        TaxDate -> accrual_date : date
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> supplier_code
        CardName -> supplier_name
        BPLId -> branch_id
        BPLName -> branch_name
        SeqCode -> series_code
        Serial -> series_number
        PeyMethod -> payment_method
        TransId -> ledger_transaction_id
        DocTotal -> document_total : decimal(20,6)
        VatSum -> total_taxes : decimal(20,6)
        GrosProfit -> gross_profit : decimal(20,6)
        Comments -> notes
        U_Store -> store_code
        """,
    ),
    "purchase_invoice_usage_pch12": (
        "pch12",
        """
        DocEntry -> doc_entry
        MainUsage -> main_usage
        """,
    ),
    "purchase_order_lines_por1": (
        "por1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        WhsCode -> warehouse_code
        Quantity -> quantity : decimal(20,6)
        OpenQty -> open_quantity : decimal(20,6)
        LineStatus -> line_status
        Price -> unit_price : decimal(20,6)
        LineTotal -> line_total : decimal(20,6)
        BaseEntry -> source_doc_entry
        BaseType -> source_document_type
        """,
    ),
    "purchase_order_opor": (
        "opor",
        """
        DocEntry -> doc_entry
        DocNum -> order_number
        DocDate -> issue_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        DocStatus -> document_status
        CANCELED -> canceled
        CardCode -> supplier_code
        CardName -> supplier_name
        DocTotal -> document_total : decimal(20,6)
        BPLId -> branch_id
        UserSign -> user_id
        """,
    ),
    "purchase_requisition_lines_prq1": (
        "prq1",
        """
        DocEntry -> doc_entry
        LineNum -> line_number
        ItemCode -> item_code
        WhsCode -> warehouse_code
        Quantity -> quantity : decimal(20,6)
        OpenQty -> open_quantity : decimal(20,6)
        LineStatus -> line_status
        """,
    ),
    "purchase_requisition_oprq": (
        "oprq",
        """
        DocEntry -> doc_entry
        DocNum -> requisition_number
        DocDate -> issue_date : date
        CreateDate -> creation_date : date
        UpdateDate -> updated_date : date
        DocStatus -> document_status
        CANCELED -> canceled
        UserSign -> user_id
        BPLId -> branch_id
        U_externalTicket -> external_ticket
        U_externalTicketDate -> external_ticket_date : date
        """,
    ),
    "chart_of_accounts_oact": (
        "oact",
        """
        AcctCode -> account_code
        AcctName -> account_name
        """,
    ),
    "journal_entry_lines_jdt1": (
        "jdt1",
        """
        TransId -> transaction_id
        Line_ID -> line_number
        Account -> ledger_account
        Credit -> credit : decimal(20,6)
        Debit -> debit : decimal(20,6)
        RefDate -> reference_date : date
        ShortName -> partner_code
        ContraAct -> offset_account
        TransType -> transaction_type
        """,
    ),
    "journal_entry_ojdt": (
        "ojdt",
        """
        TransId -> transaction_id
        RefDate -> reference_date : date
        TransType -> transaction_type
        Memo -> historical
        BaseRef -> document_reference
        """,
    ),
    "outgoing_payment_ovpm": (
        "ovpm",
        """
        DocEntry -> doc_entry
        DocNum -> payment_number
        DocType -> payment_type
        DocDate -> payment_date : date
        TaxDate -> accrual_date : date
        DocDueDate -> due_date : date
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        Canceled -> canceled
        CardCode -> partner_code
        CardName -> partner_name
        BPLId -> branch_id
        DocTotal -> payment_total : decimal(20,6)
        DocCurr -> currency
        CashSum -> cash_amount : decimal(20,6)
        TrsfrSum -> transfer_amount : decimal(20,6)
        CheckSum -> check_amount : decimal(20,6)
        CreditSum -> credit_amount : decimal(20,6)
        NoDocSum -> amount_without_document : decimal(20,6)
        TransId -> ledger_transaction_id
        JrnlMemo -> historical
        """,
    ),
    "inventory_movement_oinm": (
        "oinm",
        """
        TransNum -> transaction_number
        DocDate -> movement_date : date
        ItemCode -> item_code
        Warehouse -> warehouse_code
        InQty -> inflow_quantity : decimal(20,6)
        OutQty -> outflow_quantity : decimal(20,6)
        TransValue -> transaction_amount : decimal(20,6)
        CalcPrice -> calculated_average_price : decimal(20,6)
        Balance -> inventory_value_after_movement : decimal(20,6)
        TransType -> transaction_type
        CreatedBy -> source_doc_entry
        BASE_REF -> source_document_number
        DocLineNum -> source_line_number
        """,
    ),
    "item_class": (
        "item_class",
        """
        Code -> class_code
        Name -> class_name
        """,
    ),
    "item_family": (
        "item_family",
        """
        Code -> family_code
        Name -> family_name
        """,
    ),
    "item_master_oitm": (
        "oitm",
        """
        ItemCode -> item_code
        ItemName -> item_name
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        FirmCode -> manufacturer_code
        InvntryUom -> unit_of_measure
        InvntItem -> inventory_item
        SellItem -> sales_item
        PrchseItem -> purchase_item
        OnHand -> inventory_quantity : decimal(20,6)
        ItmsGrpCod -> item_group_code
        frozenFor -> inactive
        validFor -> active
        U_CLASS -> class
        U_FAMILY -> family
        U_SUB_CLASS -> sub_class
        U_CURVE -> abc_curve
        U_MADE_TO_ORDER -> made_to_order
        U_LEAD_TIME -> lead_time_days
        U_SCORE -> score
        SWeight1 -> gross_weight : decimal(20,6)
        """,
    ),
    "item_price_itm1": (
        "itm1",
        """
        ItemCode -> item_code
        PriceList -> price_list_number
        Price -> price : decimal(20,6)
        """,
    ),
    "item_sub_class": (
        "item_sub_class",
        """
        Code -> sub_class_code
        Name -> sub_class_name
        """,
    ),
    "warehouse_stock_oitw": (
        "oitw",
        """
        ItemCode -> item_code
        WhsCode -> warehouse_code
        OnHand -> inventory_quantity : decimal(20,6)
        IsCommited -> committed_quantity : decimal(20,6)
        OnOrder -> ordered_quantity : decimal(20,6)
        AvgPrice -> average_price : decimal(20,6)
        """,
    ),
    "additional_expense_oexd": (
        "oexd",
        """
        ExpnsCode -> expense_code
        ExpnsName -> expense_name
        """,
    ),
    "branch_obpl": (
        "obpl",
        """
        BPLId -> branch_id
        BPLName -> branch_name
        U_NOMENCLATURE -> nomenclature
        """,
    ),
    "business_partner_ocrd": (
        "ocrd",
        """
        CardCode -> partner_code
        CardName -> partner_name
        CardFName -> foreign_name
        UpdateDate -> updated_date : date
        UpdateTS -> update_ts
        GroupCode -> group_code
        CardType -> partner_type
        Balance -> balance : decimal(20,6)
        Password -> password
        LicTradNum -> cpf_cnpj
        SlpCode -> salesperson_code
        U_PARTNER_SHOW_IN_BI -> show_in_bi
        U_PRESALE -> presale_channel
        U_franchiseName -> franchise_name
        CreateDate -> registration_date : date
        """,
    ),
    "fiscal_usage_ousg": (
        "ousg",
        """
        ID -> usage_id
        Usage -> usage_description
        """,
    ),
    "invoice_series_nfn1": (
        "nfn1",
        """
        ObjectCode -> object_code
        DocSubType -> document_subtype
        SeqCode -> series_code
        SeqName -> series_name
        """,
    ),
    "manufacturer_omrc": (
        "omrc",
        """
        FirmCode -> manufacturer_code
        FirmName -> manufacturer_name
        """,
    ),
    "partner_group_ocrg": (
        "ocrg",
        """
        GroupCode -> group_code
        GroupName -> group_name
        """,
    ),
    "price_list_opln": (
        "opln",
        """
        ListNum -> price_list_number
        ListName -> price_list_name
        """,
    ),
    "salesperson_oslp": (
        "oslp",
        """
        SlpCode -> salesperson_code
        SlpName -> salesperson_name
        U_STORE -> store_code
        """,
    ),
    "store": (
        "stores",
        """
        Code -> store_code
        Name -> store_name
        """,
    ),
    "user_ousr": (
        "ousr",
        """
        INTERNAL_K -> user_id
        USER_CODE -> user_login
        U_NAME -> user_name
        Department -> department_id
        """,
    ),
    "warehouse_owhs": (
        "owhs",
        """
        WhsCode -> warehouse_code
        WhsName -> warehouse_name
        BPLid -> branch_id
        U_STORE -> store_code
        Inactive -> inactive
        """,
    ),
    "retail_goals": (
        "retail_goals",
        """
        Ordem Vendedor -> salesperson_order
        Data -> date : date
        Ordem Filial -> branch_order
        Loja -> store
        Vendedor -> salesperson
        Meta Diária -> daily_goal : decimal(20,6)
        """,
    ),
    "wholesale_goals": (
        "wholesale_goals",
        """
        Ordem Vendedor -> salesperson_order
        Data -> date : date
        Ordem Filial -> branch_order
        Loja -> store
        Vendedor -> salesperson
        Meta Diária -> daily_goal : decimal(20,6)
        """,
    ),
    "store_mapping": (
        "store_mapping",
        """
        ANTIGO -> old_store_name
        NOVO -> new_store_name
        CEP -> postal_code : postal
        """,
    ),
}


def mapping(name: str) -> list[tuple[str, str, str]]:
    """(raw column, staging name, rule or '') of one staging projection."""
    rows = []
    for line in STAGING[name][1].strip().splitlines():
        raw, _, target = line.strip().partition(" -> ")
        staged, _, rule = target.partition(" : ")
        rows.append((raw, staged, rule))
    return rows


def project(raw: DataFrame, name: str, *carried: str) -> DataFrame:
    """Apply the staging projection `name` to its raw table; `carried` columns pass as they are."""
    rows = mapping(name)
    cleaned = {source: _CLEANING[rule](F.col(f"`{source}`")) for source, _, rule in rows if rule in _CLEANING}
    columns = [
        f"CAST(`{source}` AS {rule}) AS {staged}" if rule and rule not in _CLEANING else f"`{source}` AS {staged}"
        for source, staged, rule in rows
    ]
    return (raw.withColumns(cleaned) if cleaned else raw).selectExpr(*columns, STAMP, *carried)


def stamp_ingested_at(df: DataFrame, run_ts: Column) -> DataFrame:
    """Add the load stamp; the run time is an argument, so reruns give equal rows."""
    return df.withColumn(STAMP, run_ts.cast("timestamp_ntz"))
