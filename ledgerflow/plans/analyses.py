"""Consumer analyses on the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.measures import guarded_ratio, product, total
from ledgerflow.plans.warehouse import Warehouse

# fixed values: numeric source-document types and the document they point to
SALES_SOURCE = {13: "invoice", 15: "delivery", 17: "order", 23: "quote"}
PURCHASE_SOURCE = {18: "invoice", 22: "order", 1470000113: "requisition"}


def revenue_by_month_channel(w: Warehouse) -> DataFrame:
    """Net revenue and gross profit per month and presale channel."""
    sales = w.model("fact_sales", "date", "presale_channel", "line_total", "gross_profit")
    return sales.groupBy(F.trunc("date", "month").alias("month"), "presale_channel").agg(
        total(F.sum("line_total")).alias("net_revenue"),
        total(F.sum("gross_profit")).alias("gross_profit"),
        F.count(F.lit(1)).alias("line_count"),
    )


def goals_vs_sales(w: Warehouse) -> DataFrame:
    """Goal against net revenue per employee and day; each fact is summed before the join."""
    keys = ["employee_code", "date"]
    goals = w.model("fact_goals", *keys, "daily_goal").groupBy(*keys).agg(
        total(F.sum("daily_goal")).alias("goal")
    )
    sales = w.model("fact_sales", *keys, "line_total").groupBy(*keys).agg(
        total(F.sum("line_total")).alias("net_revenue")
    )
    joined = goals.join(sales, keys, "left").fillna(0, ["net_revenue"])
    return joined.withColumn("attainment", guarded_ratio(F.col("net_revenue"), F.col("goal")))


def weighted_unit_rates(w: Warehouse) -> DataFrame:
    """Quantity-weighted averages of the unit rates per item and month."""
    rates = ("unit_price", "price_before_discount", "discount_percentage", "inventory_cost_price")
    sales = w.model("fact_sales", "item_code", "date", "quantity", *rates)
    grouped = sales.groupBy("item_code", F.trunc("date", "year").alias("year_start"))
    sums = grouped.agg(
        total(F.sum("quantity")).alias("quantity"),
        *(F.sum(product(F.col(r), F.col("quantity"))).alias(r) for r in rates),
    )
    return sums.select(
        "item_code", "year_start", "quantity",
        *(guarded_ratio(F.col(r), F.col("quantity")).alias(f"avg_{r}") for r in rates),
    )


def source_links(lines: DataFrame, types: dict[int, str]) -> DataFrame:
    """Distinct links from a document to the document it was copied from."""
    kind = F
    for code, name in types.items():
        kind = kind.when(F.col("source_document_type") == code, name)
    return (
        lines.select(
            "document_type", "doc_entry", kind.alias("source_type"), F.col("source_doc_entry").alias("source_doc")
        )
        .where(F.col("source_type").isNotNull() & F.col("source_doc").isNotNull())
        .distinct()
    )


def document_trace(w: Warehouse) -> DataFrame:
    """Quote -> order -> invoice path of every invoice, with its returns counted.

    Returns are summed per invoice before the join, so an invoice with many
    returns does not multiply its path rows.
    """
    cols = ("document_type", "doc_entry", "source_doc_entry", "source_document_type")
    invoices = w.model("sales_invoice_documents", "doc_entry")
    from_invoice = source_links(w.model("sales_invoice_lines", *cols), SALES_SOURCE)
    from_order = source_links(w.model("sales_order_lines", *cols), SALES_SOURCE)

    def linked(links: DataFrame, to: str, child: str, parent: str) -> DataFrame:
        return links.where(F.col("source_type") == to).select(
            F.col("doc_entry").alias(child), F.col("source_doc").alias(parent)
        )

    returns = (
        w.model("sales_return_lines", "doc_entry", "effective_source_doc_entry", "line_total")
        .groupBy("effective_source_doc_entry", "doc_entry")
        .agg(F.sum("line_total").alias("line_total"))
        .groupBy(F.col("effective_source_doc_entry").alias("invoice"))
        .agg(F.count(F.lit(1)).alias("return_count"), total(F.sum("line_total")).alias("returned_total"))
    )
    path = (
        invoices.withColumnRenamed("doc_entry", "invoice")
        .join(linked(from_invoice, "order", "invoice", "order"), "invoice", "left")
        .join(linked(from_order, "quote", "order", "quote_of_order"), "order", "left")
        .join(linked(from_invoice, "quote", "invoice", "quote_of_invoice"), "invoice", "left")
        .join(returns, "invoice", "left")
    )
    return path.select(
        "invoice", "order",
        F.coalesce("quote_of_order", "quote_of_invoice").alias("quote"),
        F.coalesce("return_count", F.lit(0)).alias("return_count"),
        F.coalesce("returned_total", total(F.lit(0))).alias("returned_total"),
    )


def purchase_trace(w: Warehouse) -> DataFrame:
    """Links between purchase documents, with the lines carrying them counted."""
    cols = ("document_type", "doc_entry", "source_doc_entry", "source_document_type")
    links = source_links(w.model("purchases_fiscal_lines", *cols), PURCHASE_SOURCE)
    return links.groupBy("document_type", "source_type").agg(F.count(F.lit(1)).alias("links"))


# fixed values: upper day bound of each ageing bucket
AGEING = ((0, "current"), (30, "1-30"), (60, "31-60"), (90, "61-90"))


def receivables_ageing(w: Warehouse) -> DataFrame:
    """Open balance per customer and days past the last due date."""
    late = F.date_diff(F.lit(w.params.as_of), "last_due_date")
    bucket = F
    for limit, label in AGEING:
        bucket = bucket.when(late <= limit, label)
    rows = w.model("fact_accounts_receivable", "partner_code", "last_due_date", "open_balance")
    return (
        rows.where(F.col("open_balance") > 0)
        .groupBy("partner_code", bucket.otherwise(">90").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("invoices"), total(F.sum("open_balance")).alias("open_balance"))
    )


def days_without_movement(w: Warehouse) -> DataFrame:
    """Idle days between one movement day and the next, per item and warehouse."""
    days = w.model("fact_daily_inventory_movement", "item_code", "warehouse_code", "date")
    following = F.lead("date").over(Window.partitionBy("item_code", "warehouse_code").orderBy("date"))
    return days.withColumn("next_date", following).withColumn(
        "idle_days", F.date_diff("next_date", "date") - 1
    )


def balance_as_of(w: Warehouse, day) -> DataFrame:
    """Latest closed-day balance on or before `day` per item and warehouse."""
    state = ("inventory_value_after_movement", "quantity_after_movement")
    daily = w.model("fact_daily_inventory_movement", "item_code", "warehouse_code", "date", *state)
    return (
        daily.where(F.col("date") <= F.lit(day))
        .groupBy("item_code", "warehouse_code")
        .agg(F.max("date").alias("balance_date"), *(F.max_by(c, "date").alias(c) for c in state))
    )
