"""Output contract of every built model: column order and Spark types.

Money and quantities are decimal(20,6), percentages decimal(18,4), parsed
price texts decimal(18,2).  Document and transaction keys are bigint: they
grow with the data and would overflow a 32-bit int on a large cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# fixed values: model -> output columns, in output order
COLUMNS: dict[str, list[str]] = {}
COLUMNS["dim_date"] = """
    date year quarter month month_name month_short_name month_year day day_of_year
    day_of_week day_of_week_name day_of_week_short_name weekend week_of_year iso_week
    week_start week_end month_start month_end quarter_start quarter_end year_start
    year_end previous_day next_day same_day_previous_year
""".split()
COLUMNS["dim_employees"] = """
    employee_code employee_name sap_full_name status hire_date
""".split()
COLUMNS["dim_item"] = """
    item_code item_name family_code family_name class_code class_name sub_class_code
    sub_class_name abc_curve unit_of_measure unit_weight_kg lead_time_days
    is_stockable is_sellable is_purchased is_made_to_order valid_for_use blocked
    manufacturer_code manufacturer_name item_type code_prefix category_code
""".split()
COLUMNS["dim_partner"] = """
    partner_code partner_name partner_type group_code group_name salesperson_code
    franchise_name presale_channel cpf_cnpj_official cpf_cnpj_normalized cpf_cnpj_type
    registration_date updated_date show_in_bi
""".split()
COLUMNS["dim_store"] = """
    store_code store_name
""".split()
COLUMNS["dim_warehouse"] = """
    warehouse_code warehouse_name branch_id branch_name branch_nomenclature store_code
    store_name
""".split()
COLUMNS["fact_accounts_receivable"] = """
    document_type doc_entry document_number date partner_code employee_code store_code
    first_due_date last_due_date load_kit presale_channel total_amount paid_amount
    open_balance installment_count paid_installment_count open_installment_count
    partial_installment_count payment_status
""".split()
COLUMNS["fact_daily_inventory_movement"] = """
    date item_code warehouse_code item_name family_code family_name class_code
    class_name sub_class_code sub_class_name abc_curve unit_of_measure warehouse_name
    branch_id branch_name store_code store_name inflow_quantity outflow_quantity
    movement_quantity transacted_amount movement_count calculated_average_price
    inventory_value_after_movement quantity_after_movement
""".split()
COLUMNS["fact_inventory"] = """
    item_code warehouse_code item_name family_code family_name class_code class_name
    sub_class_code sub_class_name abc_curve unit_of_measure warehouse_name branch_id
    branch_name store_code store_name inventory_quantity committed_quantity
    ordered_quantity list_price inventory_value_at_list_price outflow_quantity_30d
    outflow_quantity_45d outflow_quantity_60d outflow_quantity_ytd turnover_30d
    turnover_45d turnover_60d turnover_ytd coverage_days_30d coverage_days_45d
    coverage_days_60d coverage_days_ytd last_outflow_date days_without_outflow
""".split()
COLUMNS["fact_purchases"] = """
    document_id document_type doc_entry line_number document_number issue_date
    accrual_date due_date item_code partner_code store_code warehouse_code branch_id
    usage_id main_usage_id main_usage_description ledger_account payment_method
    quantity line_total total_taxes total_cost unit_price price_before_discount
    discount_percentage inventory_cost_price
""".split()
COLUMNS["fact_goals"] = """
    channel date employee_code original_goal_store original_goal_salesperson
    normalized_name goal_store_text goal_store_code goal_store_name bridge_source
    daily_goal
""".split()
COLUMNS["fact_sales"] = """
    document_id document_type doc_entry line_number document_number date item_code
    partner_code employee_code store_code warehouse_code usage_id main_usage_id
    main_usage_description cfop presale_channel load_kit canceled quantity line_total
    total_taxes total_cost gross_profit unit_price price_before_discount
    discount_percentage inventory_cost_price bdi_price cost_price sap_margin
""".split()
COLUMNS["employee"] = """
    employee_code employee_name sap_full_name status
""".split()
COLUMNS["finance_journal_entries"] = """
    transaction_id line_number reference_date transaction_type historical
    document_reference ledger_account account_name offset_account offset_account_name
    debit credit partner_code partner_name partner_type group_code group_name
    _ingested_at
""".split()
COLUMNS["finance_payments"] = """
    doc_entry payment_number payment_type payment_date accrual_date due_date
    updated_date canceled partner_code partner_name partner_type group_code group_name
    cpf_cnpj_official cpf_cnpj_normalized branch_id branch_name branch_nomenclature
    payment_total currency cash_amount transfer_amount check_amount credit_amount
    amount_without_document ledger_transaction_id historical _ingested_at
""".split()
COLUMNS["current_inventory"] = """
    item_code warehouse_code inventory_quantity committed_quantity ordered_quantity
    average_cost_price item_name family_code family_name class_code class_name
    sub_class_code sub_class_name abc_curve unit_of_measure warehouse_name branch_id
    branch_name store_code store_name warehouse_inactive
""".split()
COLUMNS["inventory_movements"] = """
    transaction_number movement_date item_code warehouse_code inflow_quantity
    outflow_quantity movement_quantity transaction_amount calculated_average_price
    inventory_value_after_movement quantity_after_movement movement_direction
    transaction_type transaction_type_description source_doc_entry
    source_document_number source_line_number item_name family_code family_name
    class_code class_name sub_class_code sub_class_name abc_curve unit_of_measure
    is_stockable warehouse_name branch_id branch_name store_code store_name
    _ingested_at
""".split()
COLUMNS["item"] = """
    item_code item_name family_code family_name class_code class_name sub_class_code
    sub_class_name abc_curve unit_of_measure unit_weight_kg lead_time_days
    is_stockable is_sellable is_purchased is_made_to_order valid_for_use blocked
    manufacturer_code manufacturer_name
""".split()
COLUMNS["item_price_list"] = """
    item_code price_list_number price_list_name list_price
""".split()
COLUMNS["partner"] = """
    partner_code partner_name partner_type group_code group_name salesperson_code
    franchise_name presale_channel show_in_bi cpf_cnpj_official cpf_cnpj_normalized
    registration_date updated_date
""".split()
COLUMNS["purchases_fiscal_usage_invoice"] = """
    doc_entry main_usage_id main_usage_description
""".split()
COLUMNS["purchases_invoice_documents"] = """
    document_id document_type doc_entry document_number issue_date accrual_date
    due_date creation_date updated_date document_status canceled supplier_code
    supplier_name group_code group_name partner_show_in_bi cpf_cnpj_official
    cpf_cnpj_normalized branch_id branch_name branch_nomenclature series_code
    series_number payment_method ledger_transaction_id user_id user_login user_name
    store_code store_name document_total total_taxes gross_profit external_ticket
    external_ticket_date _ingested_at
""".split()
COLUMNS["purchases_invoice_lines"] = """
    document_type doc_entry line_number item_code warehouse_code quantity
    open_quantity line_status unit_price price_before_discount discount_percentage
    line_total total_taxes inventory_cost_price ledger_account usage_id
    source_doc_entry source_document_type main_usage_id main_usage_description
    item_name family_code family_name class_code class_name sub_class_code
    sub_class_name abc_curve unit_of_measure manufacturer_code _ingested_at
""".split()
COLUMNS["purchases_order_documents"] = COLUMNS["purchases_invoice_documents"]
COLUMNS["purchases_order_lines"] = COLUMNS["purchases_invoice_lines"]
COLUMNS["purchases_requisition_documents"] = COLUMNS["purchases_invoice_documents"]
COLUMNS["purchases_requisition_lines"] = COLUMNS["purchases_invoice_lines"]
COLUMNS["goal_name_entry"] = """
    normalized_name first_goal
""".split()
COLUMNS["sales_delivery_documents"] = """
    doc_entry delivery_number issue_date creation_date updated_date document_status
    canceled customer_code partner_name group_code group_name franchise_name
    cpf_cnpj_official cpf_cnpj_normalized partner_show_in_bi branch_id branch_name
    branch_nomenclature _ingested_at
""".split()
COLUMNS["sales_delivery_lines"] = """
    doc_entry line_number item_code warehouse_code quantity line_status
    source_doc_entry source_line_number source_document_type item_name family_code
    family_name class_code class_name sub_class_code sub_class_name abc_curve
    unit_of_measure manufacturer_code _ingested_at
""".split()
COLUMNS["sales_expenses"] = """
    document_type doc_entry line_number expense_code expense_name expense_amount
    _ingested_at
""".split()
COLUMNS["sales_fiscal_usage_invoice"] = COLUMNS["purchases_fiscal_usage_invoice"]
COLUMNS["sales_fiscal_usage_quote"] = COLUMNS["purchases_fiscal_usage_invoice"]
COLUMNS["sales_fiscal_usage_return"] = COLUMNS["purchases_fiscal_usage_invoice"]
COLUMNS["sales_freight_document"] = """
    document_type doc_entry freight_amount
""".split()
COLUMNS["sales_goals"] = """
    channel date original_goal_salesperson original_goal_store daily_goal
    normalized_name goal_store_text salesperson_code salesperson_name goal_store_code
    goal_store_name bridge_source
""".split()
COLUMNS["sales_installments"] = """
    doc_entry installment_number due_date installment_amount paid_amount open_balance
    installment_status _ingested_at
""".split()
COLUMNS["sales_invoice_documents"] = """
    document_id document_type doc_entry document_number issue_date accrual_date
    expected_delivery_date creation_date updated_date document_status canceled
    customer_code partner_name partner_type group_code group_name franchise_name
    cpf_cnpj_official cpf_cnpj_normalized partner_show_in_bi salesperson_code
    salesperson_name salesperson_store_code salesperson_store_name branch_id
    branch_name branch_nomenclature store_code document_store_name display_store_name
    series_code series_number payment_method ledger_transaction_id document_total
    gross_profit header_discount total_taxes freight_amount presale_channel load_kit
    finance_validated document_show_in_bi triangulation _ingested_at
""".split()
COLUMNS["sales_invoice_lines"] = """
    document_type doc_entry line_number item_code item_description quantity
    open_quantity unit_price price_before_discount discount_percentage line_total
    total_taxes inventory_cost_price line_status usage_id cfop warehouse_code
    source_doc_entry source_line_number effective_source_doc_entry
    source_document_type doc_entry_sales_invoice bdi_price cost_price margin
    main_usage_id main_usage_description item_name family_code family_name class_code
    class_name sub_class_code sub_class_name abc_curve unit_of_measure
    manufacturer_code _ingested_at
""".split()
COLUMNS["sales_order_documents"] = COLUMNS["sales_invoice_documents"]
COLUMNS["sales_order_lines"] = COLUMNS["sales_invoice_lines"]
COLUMNS["sales_prices_invoice"] = """
    doc_entry line_number line_key bdi_price cost_price
""".split()
COLUMNS["sales_prices_quote"] = COLUMNS["sales_prices_invoice"]
COLUMNS["sales_prices_return"] = COLUMNS["sales_prices_invoice"]
COLUMNS["sales_quote_documents"] = COLUMNS["sales_invoice_documents"]
COLUMNS["sales_quote_lines"] = COLUMNS["sales_invoice_lines"]
COLUMNS["sales_return_documents"] = COLUMNS["sales_invoice_documents"]
COLUMNS["sales_return_lines"] = COLUMNS["sales_invoice_lines"]
COLUMNS["sales_store_salesperson"] = """
    salesperson_code salesperson_name salesperson_store_code salesperson_store_name
""".split()
COLUMNS["salesperson_bridge"] = """
    salesperson_code salesperson_name normalized_name store_code store_name store_text
    role valid_from valid_to source
""".split()
COLUMNS["standardized_store"] = """
    store_code old_store_name new_store_name
""".split()
COLUMNS["user"] = """
    user_id user_login user_name department_id
""".split()
COLUMNS["warehouse"] = """
    warehouse_code warehouse_name branch_id branch_name branch_nomenclature store_code
    store_name inactive
""".split()
COLUMNS["sales_fiscal_documents"] = COLUMNS["sales_invoice_documents"]
COLUMNS["sales_fiscal_lines"] = COLUMNS["sales_invoice_lines"]
COLUMNS["purchases_fiscal_documents"] = COLUMNS["purchases_invoice_documents"]
COLUMNS["purchases_fiscal_lines"] = COLUMNS["purchases_invoice_lines"]

MONEY = "decimal(20,6)"

# fixed values: columns by type; every column not listed is a string
_TYPED = {
    MONEY: """
        quantity open_quantity line_total total_taxes total_cost gross_profit unit_price
        price_before_discount inventory_cost_price document_total header_discount
        freight_amount total_amount paid_amount open_balance payment_total cash_amount
        transfer_amount check_amount credit_amount amount_without_document debit credit
        calculated_average_price inventory_value_after_movement quantity_after_movement
        inventory_quantity committed_quantity ordered_quantity list_price
        inventory_value_at_list_price outflow_quantity_30d outflow_quantity_45d
        outflow_quantity_60d outflow_quantity_ytd turnover_30d turnover_45d turnover_60d
        turnover_ytd coverage_days_30d coverage_days_45d coverage_days_60d
        coverage_days_ytd daily_goal unit_weight_kg average_cost_price expense_amount
        installment_amount inflow_quantity outflow_quantity movement_quantity
        transacted_amount transaction_amount
    """,
    "decimal(18,4)": "discount_percentage margin sap_margin",
    "decimal(18,2)": "bdi_price cost_price",
    "date": """
        date issue_date accrual_date due_date expected_delivery_date creation_date
        updated_date payment_date reference_date movement_date external_ticket_date
        registration_date hire_date first_due_date last_due_date last_outflow_date
        first_goal valid_from valid_to week_start week_end month_start month_end
        quarter_start quarter_end year_start year_end previous_day next_day
        same_day_previous_year
    """,
    "bigint": """
        doc_entry document_number delivery_number payment_number ledger_transaction_id
        transaction_id source_doc_entry effective_source_doc_entry
        doc_entry_sales_invoice movement_count installment_count paid_installment_count
        open_installment_count partial_installment_count
    """,
    "decimal(38,0)": "transaction_number line_number source_line_number",
    "int": """
        source_document_type usage_id main_usage_id
        branch_id group_code salesperson_code employee_code series_code series_number
        user_id department_id manufacturer_code price_list_number installment_number
        expense_code lead_time_days days_without_outflow year quarter month day
        day_of_year day_of_week week_of_year iso_week
    """,
    "timestamp_ntz": "_ingested_at",
}
_TYPE_OF = {name: kind for kind, names in _TYPED.items() for name in names.split()}


def column_type(model: str, column: str) -> str:
    """Spark type of one contract column."""
    if column == "transaction_type":  # ledger: text code; stock movements: number
        return "int" if model == "inventory_movements" else "string"
    return _TYPE_OF.get(column, "string")


def conform(df: DataFrame, model: str, columns: list[str] | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """Project to the contract: order, names and explicit output types; `carried` columns pass as they are.

    Contract columns the frame lacks become typed NULLs, so a document type
    that does not carry an attribute still fits the shared schema.
    """
    have = set(df.columns)
    return df.selectExpr(
        *(
            f"CAST({c if c in have else 'NULL'} AS {column_type(model, c)}) AS {c}"
            for c in columns or COLUMNS[model]
        ),
        *carried,
    )
