"""Sales documents, lines, satellites and goals."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import codes, text
from ledgerflow.functions.predicates import freight_expense
from ledgerflow.operators.joins import code_or_name, lookup, temporal_left_join
from ledgerflow.operators.latest import first_per_key, latest_per_key
from ledgerflow.operators.setops import union_bricks, union_labelled
from ledgerflow.plans.common import goal_rows, item_labels, with_branch, with_partner
from ledgerflow.plans.warehouse import Warehouse, model


@dataclass(frozen=True)
class DocumentKind:
    """What differs between the four sales document types."""

    header: str
    lines: str
    id_prefix: str
    number: str
    load_kit: Mapping[str, str | None]
    resolve_store: bool  # the header's store text may be a name
    freight: bool
    usage: str | None  # header usage table


# fixed values: staging tables and id prefixes per document type
KINDS = {
    "invoice": DocumentKind(
        "sales_invoice_oinv", "sales_invoice_lines_inv1", "nf", "invoice_number", codes.LOAD_KIT,
        True, True, "sales_invoice_usage_inv12",
    ),
    "quote": DocumentKind(
        "quote_oqut", "quote_lines_qut1", "orc", "quote_number", codes.LOAD_KIT_QUOTE,
        False, False, "quote_usage_qut12",
    ),
    "return": DocumentKind(
        "sales_return_orin", "sales_return_lines_rin1", "dev", "return_number", codes.LOAD_KIT,
        True, True, "sales_return_usage_rin12",
    ),
    "order": DocumentKind(
        "sales_order_ordr", "sales_order_lines_rdr1", "ped", "order_number", codes.LOAD_KIT,
        False, False, None,
    ),
}

_PARTNER = {
    "partner_name": "partner_name", "partner_type": "partner_type", "group_code": "group_code",
    "group_name": "group_name", "franchise_name": "franchise_name",
    "cpf_cnpj_official": "cpf_cnpj_official", "cpf_cnpj_normalized": "cpf_cnpj_normalized",
    "partner_show_in_bi": "show_in_bi", "_partner_channel": "presale_channel",
}
_LABELS = {
    "document_status": codes.DOCUMENT_STATUS, "canceled": codes.CANCELED,
    "presale_channel": codes.PRESALE_CHANNEL, "finance_validated": codes.FINANCE_VALIDATED,
    "show_in_bi": codes.SIM_NAO, "triangulation": codes.TRIANGULATION,
}


def newest_versions(df: DataFrame) -> DataFrame:
    tie_breakers = [c for c in ("updated_date", "update_ts", "document_total") if c in df.columns]
    return latest_per_key(df, ["doc_entry"], "_ingested_at", *tie_breakers)


def translated(df: DataFrame, labels: Mapping[str, Mapping[str, str | None]]) -> DataFrame:
    present = {c: codes.translate_code(F.col(c), m) for c, m in labels.items() if c in df.columns}
    return df.withColumns(present)


def sales_documents(w: Warehouse, kind: str, need: set[str]) -> DataFrame:
    spec = KINDS[kind]
    docs = newest_versions(w.stage(spec.header))
    docs = translated(docs, {**_LABELS, "load_kit": spec.load_kit})
    if "payment_method" in docs.columns:
        docs = docs.withColumn("payment_method", F.lower("payment_method"))
    docs = (
        docs.withColumnRenamed(spec.number, "document_number")
        .withColumnRenamed("show_in_bi", "document_show_in_bi")
        .drop("branch_name")
        .withColumn("document_type", F.lit(kind))
        .withColumn("document_id", text.prefixed_id(spec.id_prefix, F.col("doc_entry")))
    )

    stores = w.stage("store")
    if spec.resolve_store:
        resolver = code_or_name(stores, "store_code", "store_name").withColumnsRenamed(
            {"entry": "store_code", "resolved": "_resolved"}
        )
        docs = docs.join(resolver, "store_code", "left").drop("store_code").withColumnRenamed("_resolved", "store_code")
    if "store_code" in docs.columns:
        named = need | ({"document_store_name"} if "display_store_name" in need else set())
        docs = lookup(
            docs, stores, {"store_code": "store_code"}, {"document_store_name": F.lower("store_name")}, named
        )

    if "presale_channel" in need:
        need = need | {"_partner_channel"}
    docs = with_partner(w, docs, "customer_code", need, **_PARTNER)
    if "presale_channel" in need:
        own = [F.col("presale_channel")] if "presale_channel" in docs.columns else []
        docs = docs.withColumn("presale_channel", F.coalesce(*own, F.col("_partner_channel")))

    if "display_store_name" in need:
        need = need | {"salesperson_store_name"}
    sellers = {c: F.col(c) for c in ("salesperson_name", "salesperson_store_code", "salesperson_store_name")}
    docs = lookup(
        docs, w.model("sales_store_salesperson"), {"salesperson_code": "salesperson_code"}, sellers, need
    )
    if "display_store_name" in need:
        own = [F.col("document_store_name")] if "document_store_name" in docs.columns else []
        docs = docs.withColumn("display_store_name", F.coalesce(*own, F.col("salesperson_store_name")))

    docs = with_branch(w, docs, need)
    if "freight_amount" in need:
        if spec.freight:
            freight = w.model("sales_freight_document").where(F.col("document_type") == kind)
            docs = lookup(docs, freight, {"doc_entry": "doc_entry"}, {"freight_amount": F.col("freight_amount")})
            docs = docs.fillna(0, ["freight_amount"])
        else:
            docs = docs.withColumn("freight_amount", F.lit(0))
    return docs


def header_usage(w: Warehouse, staging: str, need: set[str] | None = None) -> DataFrame:
    """Fiscal usage of a document header with its description."""
    usage = w.stage(staging).select("doc_entry", F.col("main_usage").alias("main_usage_id"))
    return lookup(
        usage, w.stage("fiscal_usage_ousg"), {"main_usage_id": "usage_id"},
        {"main_usage_description": F.lower("usage_description")}, need,
    )


USAGE_COLUMNS = ("main_usage_id", "main_usage_description")


def usage_labels(w: Warehouse, usage: str, need: set[str]) -> dict[str, DataFrame]:
    """The header usage columns (of a usage model) that are needed, by the document key; nothing if none is."""
    used = [c for c in USAGE_COLUMNS if c in need]
    return {"doc_entry": w.model(usage, "doc_entry", *used)} if used else {}


def with_header_usage(w: Warehouse, df: DataFrame, usage: str, need: set[str]) -> DataFrame:
    """Attach the header usage (a usage model) on the document key."""
    for key, label in usage_labels(w, usage, need).items():
        df = df.join(label, key, "left")
    return df


def sales_lines(w: Warehouse, kind: str, need: set[str], headers: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Lines with header usage and item hierarchy, and with their headers where such are given.

    Prices are parsed on the line itself: the line key is unique, so joining
    the line-price table back would only repeat the same row.
    """
    spec = KINDS[kind]
    labels = usage_labels(w, f"sales_fiscal_usage_{kind}", need) if spec.usage else {}
    labels |= item_labels(w, need, "manufacturer_code")
    lines = w.stage_labelled(spec.lines, labels, headers).withColumn("document_type", F.lit(kind))
    return lines.withColumns(
        {c: F.lower(c) for c in ("item_description", "cfop") if c in lines.columns}
    )


def _register_kind(kind: str) -> None:
    @model(f"sales_{kind}_documents")
    def documents(w: Warehouse, need: set[str]) -> DataFrame:
        return sales_documents(w, kind, need)

    @model(f"sales_{kind}_lines")
    def lines(w: Warehouse, need: set[str], headers: Mapping[str, DataFrame] | None = None) -> DataFrame:
        return sales_lines(w, kind, need, headers)

    spec = KINDS[kind]
    if spec.usage:

        @model(f"sales_fiscal_usage_{kind}")
        def usage(w: Warehouse, need: set[str]) -> DataFrame:
            return header_usage(w, spec.usage, need)

        @model(f"sales_prices_{kind}")
        def prices(w: Warehouse, need: set[str]) -> DataFrame:
            key = text.line_key(F.col("doc_entry"), F.col("line_number"))
            return w.stage(spec.lines).withColumn("line_key", key)


for _kind in KINDS:
    _register_kind(_kind)


@model("sales_fiscal_documents")
def sales_fiscal_documents(w: Warehouse, need: set[str]) -> DataFrame:
    return union_bricks(w.model(f"sales_{kind}_documents", *sorted(need)) for kind in KINDS)


@model("sales_fiscal_lines")
def sales_fiscal_lines(w: Warehouse, need: set[str]) -> DataFrame:
    return union_bricks(w.model(f"sales_{kind}_lines", *sorted(need)) for kind in KINDS)


@model("sales_expenses")
def sales_expenses(w: Warehouse, need: set[str]) -> DataFrame:
    both = union_labelled(
        {
            "invoice": w.stage("sales_invoice_expenses_inv3"),
            "return": w.stage("sales_return_expenses_rin3"),
        },
        "document_type",
    )
    return lookup(
        both, w.stage("additional_expense_oexd"), {"expense_code": "expense_code"},
        {"expense_name": F.lower("expense_name")}, need,
    )


@model("sales_freight_document")
def sales_freight_document(w: Warehouse, need: set[str]) -> DataFrame:
    expenses = w.model("sales_expenses", "document_type", "doc_entry", "expense_code", "expense_amount")
    return (
        expenses.where(freight_expense(F.col("expense_code")))
        .groupBy("document_type", "doc_entry")
        .agg(F.sum("expense_amount").alias("freight_amount"))
    )


@model("sales_delivery_documents")
def sales_delivery_documents(w: Warehouse, need: set[str]) -> DataFrame:
    docs = translated(newest_versions(w.stage("delivery_odln")), _LABELS)
    docs = with_partner(w, docs, "customer_code", need, **_PARTNER)
    return with_branch(w, docs, need)


@model("sales_delivery_lines")
def sales_delivery_lines(w: Warehouse, need: set[str]) -> DataFrame:
    return w.stage_labelled("delivery_lines_dln1", item_labels(w, need, "manufacturer_code"))


@model("sales_installments")
def sales_installments(w: Warehouse, need: set[str]) -> DataFrame:
    rows = w.stage("sales_invoice_installments_inv6")
    rows = translated(rows, {"installment_status": codes.INSTALLMENT_STATUS})
    return rows.withColumn("open_balance", F.col("installment_amount") - F.col("paid_amount"))


@model("sales_store_salesperson")
def sales_store_salesperson(w: Warehouse, need: set[str]) -> DataFrame:
    people = w.stage("salesperson_oslp").select(
        "salesperson_code",
        F.lower("salesperson_name").alias("salesperson_name"),
        F.col("store_code").alias("salesperson_store_code"),
    )
    return lookup(
        people, w.stage("store"), {"salesperson_store_code": "store_code"},
        {"salesperson_store_name": F.lower("store_name")}, need,
    )


# the natural key of one goal line
GOAL_KEY = ["channel", "date", "original_goal_salesperson", "original_goal_store"]


def goals_with_store(w: Warehouse) -> DataFrame:
    """Latest line per goal key, with name parts and the store resolved by name."""
    renamed = goal_rows(w).withColumnsRenamed(
        {"salesperson": "original_goal_salesperson", "store": "original_goal_store"}
    )
    goals = latest_per_key(renamed, GOAL_KEY, "_ingested_at", "salesperson_order")
    person = F.col("original_goal_salesperson")
    goals = goals.select(
        *GOAL_KEY, "daily_goal",
        text.normalized_name(person).alias("normalized_name"),
        text.name_segment(person, 2).alias("goal_store_text"),
        text.goal_store_key(F.col("original_goal_store")).alias("_store_key"),
    )
    stores = w.model("standardized_store").select(
        F.col("old_store_name").alias("_store_key"),
        F.col("store_code").alias("goal_store_code"),
        F.col("new_store_name").alias("goal_store_name"),
    )
    return goals.join(stores, "_store_key", "left").drop("_store_key")


@model("sales_goals")
def sales_goals(w: Warehouse, need: set[str]) -> DataFrame:
    """Goals with the salesperson found by name and day.

    Several versions may cover the day: the one in the goal's store wins, then
    the newest.  Goals nobody covers stay, with a NULL salesperson.
    """
    versions = w.model("salesperson_bridge").select(
        "normalized_name", "valid_from", "valid_to", "salesperson_code", "salesperson_name",
        F.col("store_code").alias("_version_store"), F.col("source").alias("bridge_source"),
    )
    matched = temporal_left_join(
        goals_with_store(w), versions, "normalized_name", "date", "valid_from", "valid_to"
    )
    same_store = F.when(F.col("_version_store") == F.col("goal_store_code"), 0).otherwise(1)
    order = [same_store, F.col("valid_from").desc(), F.col("salesperson_code"), F.col("goal_store_code")]
    return first_per_key(matched, GOAL_KEY, order)
