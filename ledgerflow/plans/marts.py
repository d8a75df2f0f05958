"""Dimensions and facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.contract import COLUMNS, conform
from ledgerflow.functions import dates, predicates, text
from ledgerflow.functions.measures import (
    guarded_ratio, money, payment_status, product, sales_sign, sentinel_to_null,
)
from ledgerflow.operators.joins import match_key
from ledgerflow.operators.setops import union_bricks
from ledgerflow.plans.common import store_label, with_item
from ledgerflow.plans.inventory import in_known_places, quantity_after, stock_rows, with_warehouse
from ledgerflow.plans.sales import with_header_usage
from ledgerflow.plans.warehouse import Warehouse, model


def calendar(days: DataFrame, day: str = "date") -> DataFrame:
    """Calendar attributes of each day."""
    d = F.col(day)
    attributes = {
        "date": d, "year": F.year(d), "quarter": F.quarter(d), "month": F.month(d),
        "month_name": dates.month_name(d), "month_short_name": dates.month_short_name(d),
        "month_year": dates.month_year_label(d), "day": F.day(d), "day_of_year": F.dayofyear(d),
        "day_of_week": F.dayofweek(d), "day_of_week_name": dates.weekday_name(d),
        "day_of_week_short_name": dates.weekday_short_name(d),
        "weekend": F.when(F.dayofweek(d).isin(1, 7), "yes").otherwise("no"),
        "week_of_year": dates.week_of_year_us(d), "iso_week": F.weekofyear(d),
    }
    for part in ("week", "month", "quarter", "year"):
        attributes[f"{part}_start"] = dates.period_start(d, part)
        attributes[f"{part}_end"] = dates.period_end(d, part)
    attributes["previous_day"] = F.date_sub(d, 1)
    attributes["next_day"] = F.date_add(d, 1)
    attributes["same_day_previous_year"] = F.add_months(d, -12)
    return days.select(*(c.alias(name) for name, c in attributes.items()))


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from the earliest `first` to the latest `last` of a frame."""
    span = bounds.agg(F.min(first).alias("_first"), F.max(last).alias("_last"))
    return span.select(F.explode(F.sequence("_first", "_last")).alias("date"))


@model("dim_date")
def dim_date(w: Warehouse, need: set[str]) -> DataFrame:
    first, last = w.params.calendar_start, w.params.calendar_end
    offsets = w.raw("oinv").sparkSession.range((last - first).days + 1)
    return calendar(offsets.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date")))


@model("dim_item")
def dim_item(w: Warehouse, need: set[str]) -> DataFrame:
    code = F.col("item_code")
    kept = set(COLUMNS["item"])
    flags = {"is_sellable", "is_stockable", "is_purchased"}
    df = w.model("item", *(c for c in COLUMNS["item"] if c in (need & kept) | flags | {"item_code"}))
    return df.withColumns(
        {
            "item_type": text.item_type(*(F.col(c) for c in ("is_sellable", "is_stockable", "is_purchased"))),
            "code_prefix": text.item_prefix(code),
            "category_code": text.item_category(code),
        }
    )


@model("dim_partner")
def dim_partner(w: Warehouse, need: set[str]) -> DataFrame:
    """Every partner; whether the BI shows it is an attribute, not a filter."""
    return w.model("partner").withColumn("cpf_cnpj_type", text.tax_id_bucket(F.col("cpf_cnpj_normalized")))


@model("dim_employees")
def dim_employees(w: Warehouse, need: set[str]) -> DataFrame:
    hires = (
        w.model("salesperson_bridge", "normalized_name", "valid_from")
        .groupBy(match_key(F.col("normalized_name")).alias("_key"))
        .agg(F.min("valid_from").alias("hire_date"))
    )
    people = w.model("employee").withColumn("_key", match_key(F.col("employee_name")))
    return people.join(hires, "_key", "left")


@model("dim_store")
def dim_store(w: Warehouse, need: set[str]) -> DataFrame:
    return w.model("standardized_store").withColumn("store_name", store_label())


@model("dim_warehouse")
def dim_warehouse(w: Warehouse, need: set[str]) -> DataFrame:
    places = w.model(
        "warehouse", "warehouse_code", "warehouse_name", "branch_id", "branch_name",
        "branch_nomenclature", "store_code",
    )
    return places.join(w.model("dim_store"), "store_code", "left")


def sales_visible_document() -> Column:
    return predicates.sales_visible(F.col("partner_show_in_bi"), F.col("group_code"), F.col("branch_id"))


def sales_scope(kind: str) -> Column:
    """Fiscal scope of a line: its own usage for invoices, the header's for returns."""
    if kind == "return":
        return predicates.return_header_usage(F.col("main_usage_id"))
    return predicates.sales_usage(F.col("usage_id"))


_SALES_LINE = (
    "document_type", "doc_entry", "line_number", "item_code", "warehouse_code", "usage_id", "cfop",
    "quantity", "unit_price", "price_before_discount", "discount_percentage", "line_total",
    "total_taxes", "inventory_cost_price", "bdi_price", "cost_price", "margin",
)
_SALES_DOCUMENT = (
    "document_id", "doc_entry", "document_number", "creation_date", "customer_code",
    "salesperson_code", "store_code", "presale_channel", "load_kit", "canceled",
    "partner_show_in_bi", "document_show_in_bi", "group_code", "branch_id",
)


@model("fact_sales")
def fact_sales(w: Warehouse, need: set[str]) -> DataFrame:
    """Signed invoice and return lines.

    Each document type joins its own lines and headers on the document key.
    The header usage is attached to the headers, one row each, so the lines
    are shuffled and joined once; the union only concatenates.
    """
    quantity, cost = F.col("quantity"), F.col("inventory_cost_price")

    def signed(kind: str) -> DataFrame:
        usage_needed = need | ({"main_usage_id"} if kind == "return" else set())
        documents = w.model(f"sales_{kind}_documents", *_SALES_DOCUMENT)
        documents = with_header_usage(w, documents, f"sales_fiscal_usage_{kind}", usage_needed)
        shown = F.col("document_show_in_bi")
        # what the header alone decides goes before the join, with its rows' lines
        visible = sales_visible_document() & predicates.not_canceled_return(F.lit(kind), F.col("canceled"))
        visible = visible & sales_scope(kind) if kind == "return" else visible
        documents = documents.where(predicates.force_display(shown, visible))
        kept = w.lines_of(f"sales_{kind}_lines", _SALES_LINE, documents, "doc_entry")
        if kind != "return":
            kept = kept.where(predicates.force_display(shown, sales_scope(kind)))
        sign = sales_sign(F.lit(kind), F.col("canceled"))
        total_cost = product(quantity, cost)
        return kept.withColumns(
            {
                "date": F.col("creation_date"),
                "partner_code": F.col("customer_code"),
                "employee_code": sentinel_to_null(F.col("salesperson_code")),
                "total_cost": money(sign * total_cost),
                "gross_profit": money(sign * (F.col("line_total") - total_cost)),
                "quantity": money(sign * quantity),
                "line_total": money(sign * F.col("line_total")),
                "total_taxes": money(sign * F.col("total_taxes")),
                "sap_margin": F.col("margin"),
            }
        )

    return union_bricks(
        signed(kind).select(*(c for c in COLUMNS["fact_sales"] if c in need)) for kind in ("invoice", "return")
    )


@model("fact_goals")
def fact_goals(w: Warehouse, need: set[str]) -> DataFrame:
    goals = w.model("sales_goals")
    keep = predicates.resolved_goal(F.col("date"), F.col("salesperson_code"), w.params.goal_mart_min_year)
    return (
        goals.where(keep)
        .withColumnRenamed("salesperson_code", "employee_code")
        .withColumn("daily_goal", F.coalesce("daily_goal", F.lit(0)))
    )


_PURCHASE_LINE = (
    "document_type", "doc_entry", "line_number", "item_code", "warehouse_code", "usage_id",
    "quantity", "unit_price", "price_before_discount", "discount_percentage", "line_total",
    "total_taxes", "inventory_cost_price", "ledger_account",
)
_PURCHASE_DOCUMENT = (
    "document_id", "doc_entry", "document_number", "issue_date", "accrual_date", "due_date",
    "supplier_code", "store_code", "canceled", "partner_show_in_bi", "group_code", "branch_id",
    "payment_method",
)


@model("fact_purchases")
def fact_purchases(w: Warehouse, need: set[str]) -> DataFrame:
    documents = w.model("purchases_invoice_documents", *_PURCHASE_DOCUMENT).where(
        predicates.purchases_visible(F.col("canceled"), F.col("partner_show_in_bi"), F.col("group_code"))
    )
    documents = with_header_usage(w, documents, "purchases_fiscal_usage_invoice", need)
    joined = w.lines_of("purchases_invoice_lines", _PURCHASE_LINE, documents, "doc_entry")
    joined = joined.where(predicates.commercial_purchase(F.col("usage_id")))
    return joined.withColumns(
        {
            "partner_code": F.col("supplier_code"),
            "total_cost": product(F.col("quantity"), F.col("inventory_cost_price")),
        }
    )


@model("fact_accounts_receivable")
def fact_accounts_receivable(w: Warehouse, need: set[str]) -> DataFrame:
    """One row per invoice in scope, with its installments summed.

    Lines only decide whether an invoice is in scope, so they are reduced to
    one flag per document before the join.
    """
    amount, paid = F.col("installment_amount"), F.col("paid_amount")

    def counted(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    installments = (
        w.model("sales_installments", "doc_entry", "due_date", "installment_amount", "paid_amount", "open_balance")
        .groupBy("doc_entry")
        .agg(
            F.sum(amount).alias("total_amount"),
            F.sum(paid).alias("paid_amount"),
            F.sum("open_balance").alias("open_balance"),
            F.count(F.lit(1)).alias("installment_count"),
            counted(paid >= amount).alias("paid_installment_count"),
            counted(paid == 0).alias("open_installment_count"),
            counted((paid > 0) & (paid < amount)).alias("partial_installment_count"),
            F.min("due_date").alias("first_due_date"),
            F.max("due_date").alias("last_due_date"),
        )
    )
    sold = (
        w.model("sales_invoice_lines", "doc_entry", "usage_id")
        .groupBy("doc_entry")
        .agg(F.max(F.coalesce(predicates.sales_usage(F.col("usage_id")), F.lit(False))).alias("_sold"))
    )
    documents = w.model("sales_invoice_documents", *_SALES_DOCUMENT).join(sold, "doc_entry")
    in_scope = documents.where(
        predicates.force_display(F.col("document_show_in_bi"), F.col("_sold") & sales_visible_document())
    ).select(
        F.lit("invoice").alias("document_type"), "doc_entry", "document_number",
        F.col("creation_date").alias("date"), F.col("customer_code").alias("partner_code"),
        sentinel_to_null(F.col("salesperson_code")).alias("employee_code"),
        "store_code", "load_kit", "presale_channel",
    )
    joined = in_scope.distinct().join(installments, "doc_entry")
    return joined.withColumn("payment_status", payment_status(F.col("paid_amount"), F.col("total_amount")))


# fixed values: trailing windows of the stock fact, in days
OUTFLOW_DAYS = (30, 45, 60)


def _window_starts(as_of: dt.date) -> dict[str, dt.date]:
    return {f"{n}d": as_of - dt.timedelta(days=n) for n in OUTFLOW_DAYS} | {"ytd": dt.date(as_of.year, 1, 1)}


def _window_sums(as_of: dt.date) -> list[Column]:
    day, out = F.col("movement_date"), F.col("outflow_quantity")
    return [
        F.sum(F.when(day >= F.lit(start), out).otherwise(0)).alias(f"outflow_quantity_{label}")
        for label, start in _window_starts(as_of).items()
    ]


def outflow_windows(movements: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    """Outflow of the last N closed days and of the year so far, in one pass."""
    day, out = F.col("movement_date"), F.col("outflow_quantity")
    last = F.max(F.when(out > 0, day)).alias("last_outflow_date")
    return movements.where(predicates.closed_day(day, as_of)).groupBy(*keys).agg(*_window_sums(as_of), last)


def with_outflow(rows: DataFrame, movements: DataFrame, keys: list[str], as_of: dt.date) -> DataFrame:
    """Attach the outflow windows, NULL without a movement in any of them, and the last day with outflow.

    The sums read only the days that some window covers; of all the other
    days no more than the date is grouped.
    """
    day = F.col("movement_date")
    closed = movements.where(predicates.closed_day(day, as_of))
    sums = closed.where(day >= F.lit(min(_window_starts(as_of).values()))).groupBy(*keys).agg(*_window_sums(as_of))
    last = closed.where(F.col("outflow_quantity") > 0).groupBy(*keys).agg(F.max(day).alias("last_outflow_date"))
    return rows.join(sums, keys, "left").join(last, keys, "left")


@model("fact_inventory")
def fact_inventory(w: Warehouse, need: set[str]) -> DataFrame:
    """Stock with its outflow. The outflow joins the bare stock; labels come last and are not shuffled."""
    as_of = w.params.as_of
    keys = ["item_code", "warehouse_code"]
    stock = stock_rows(w).select(*keys, "inventory_quantity", "committed_quantity", "ordered_quantity")
    movements = w.model("inventory_movements", *keys, "movement_date", "outflow_quantity")
    stock = with_outflow(stock, movements, keys, as_of)
    stock = in_known_places(w, stock, need | {"warehouse_inactive"})
    stock = stock.where(predicates.active_warehouse(F.col("warehouse_inactive")))
    prices = (
        w.model("item_price_list", "item_code", "price_list_number", "list_price")
        .where(F.col("price_list_number") == w.params.price_list)
        .drop("price_list_number")
    )
    df = stock.join(prices, "item_code", "left")

    on_hand = F.col("inventory_quantity")
    elapsed = (as_of - dt.date(as_of.year, 1, 1)).days + 1
    lengths = {f"{n}d": n for n in OUTFLOW_DAYS} | {"ytd": elapsed}
    added = {"inventory_value_at_list_price": product(on_hand, F.col("list_price"))}
    for label, days in lengths.items():
        out = F.col(f"outflow_quantity_{label}")
        added[f"outflow_quantity_{label}"] = F.coalesce(out, F.lit(0))
        added[f"turnover_{label}"] = guarded_ratio(F.coalesce(out, F.lit(0)), on_hand)
        added[f"coverage_days_{label}"] = guarded_ratio(on_hand * F.lit(days), out)
    added["days_without_outflow"] = F.date_diff(F.lit(as_of), "last_outflow_date")
    return df.withColumns(added)


@model("fact_daily_inventory_movement")
def fact_daily_inventory_movement(w: Warehouse, need: set[str]) -> DataFrame:
    return daily_rows(w, need)


def daily_movement(w: Warehouse, since: dt.date | None = None, also: Sequence[dt.date] = ()) -> DataFrame:
    """The daily fact restricted to the closed days after `since` and the days of `also`."""
    name = "fact_daily_inventory_movement"
    return conform(daily_rows(w, set(COLUMNS[name]), since, also), name)


def daily_rows(w: Warehouse, need: set[str], since: dt.date | None = None, also: Sequence[dt.date] = ()) -> DataFrame:
    """Flow and end-of-day state per (date, item, warehouse) of the closed days after `since`, and those of `also`.

    Flow sums and the last movement's state come from one hash aggregation
    that combines on the map side; labels are attached to the daily rows, not
    to the movements. The quantity after the last movement follows from its
    price and value, so it is neither shuffled nor sorted with them.
    """
    state = ("calculated_average_price", "inventory_value_after_movement")
    flow = ("inflow_quantity", "outflow_quantity", "movement_quantity")
    keys = ["movement_date", "item_code", "warehouse_code"]
    movements = w.model(
        "inventory_movements", "transaction_number", *keys, *flow, "transaction_amount", *state
    )
    movements = movements.where(
        predicates.closed_day(F.col("movement_date"), w.params.as_of)
        & F.col("item_code").isNotNull()
        & F.col("warehouse_code").isNotNull()
    )
    if since is not None:
        wanted = F.col("movement_date") > F.lit(since)
        movements = movements.where(wanted | F.col("movement_date").isin(*also) if also else wanted)
    daily = movements.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in flow),
        F.sum("transaction_amount").alias("transacted_amount"),
        F.count(F.lit(1)).alias("movement_count"),
        *(F.max_by(c, "transaction_number").alias(c) for c in state),
    ).withColumnRenamed("movement_date", "date")
    labelled = with_warehouse(w, with_item(w, daily, need), need)
    return labelled.withColumn("quantity_after_movement", quantity_after())
