"""Purchase documents and lines."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import codes, text
from ledgerflow.operators.joins import lookup
from ledgerflow.operators.setops import union_bricks
from ledgerflow.plans.common import item_labels, with_branch, with_partner
from ledgerflow.plans.sales import header_usage, newest_versions, translated, usage_labels
from ledgerflow.plans.warehouse import Warehouse, model


@dataclass(frozen=True)
class PurchaseKind:
    header: str
    lines: str
    id_prefix: str
    number: str


# fixed values: staging tables and id prefixes per document type
KINDS = {
    "invoice": PurchaseKind("purchase_invoice_opch", "purchase_invoice_lines_pch1", "nf", "invoice_number"),
    "order": PurchaseKind("purchase_order_opor", "purchase_order_lines_por1", "ped", "order_number"),
    "requisition": PurchaseKind(
        "purchase_requisition_oprq", "purchase_requisition_lines_prq1", "req", "requisition_number"
    ),
}

_PARTNER = {
    "supplier_name": "partner_name", "group_code": "group_code", "group_name": "group_name",
    "partner_show_in_bi": "show_in_bi", "cpf_cnpj_official": "cpf_cnpj_official",
    "cpf_cnpj_normalized": "cpf_cnpj_normalized",
}


def purchase_documents(w: Warehouse, kind: str, need: set[str]) -> DataFrame:
    spec = KINDS[kind]
    docs = newest_versions(w.stage(spec.header))
    docs = translated(docs, {"document_status": codes.DOCUMENT_STATUS, "canceled": codes.CANCELED})
    docs = (
        docs.withColumnRenamed(spec.number, "document_number")
        .drop("branch_name", "supplier_name")
        .withColumn("document_type", F.lit(kind))
        .withColumn("document_id", text.prefixed_id(spec.id_prefix, F.col("doc_entry")))
    )
    if "payment_method" in docs.columns:
        docs = docs.withColumn("payment_method", F.lower("payment_method"))
    if "supplier_code" in docs.columns:
        docs = with_partner(w, docs, "supplier_code", need, **_PARTNER)
    docs = with_branch(w, docs, need)
    if "user_id" in docs.columns:
        who = {"user_login": F.col("user_login"), "user_name": F.col("user_name")}
        docs = lookup(docs, w.model("user"), {"user_id": "user_id"}, who, need)
    if "store_code" in docs.columns:
        docs = lookup(
            docs, w.stage("store"), {"store_code": "store_code"}, {"store_name": F.lower("store_name")}, need
        )
    return docs


def purchase_lines(
    w: Warehouse, kind: str, need: set[str], headers: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    labels = usage_labels(w, "purchases_fiscal_usage_invoice", need) if kind == "invoice" else {}
    labels |= item_labels(w, need, "manufacturer_code")
    return w.stage_labelled(KINDS[kind].lines, labels, headers).withColumn("document_type", F.lit(kind))


def _register_kind(kind: str) -> None:
    @model(f"purchases_{kind}_documents")
    def documents(w: Warehouse, need: set[str]) -> DataFrame:
        return purchase_documents(w, kind, need)

    @model(f"purchases_{kind}_lines")
    def lines(w: Warehouse, need: set[str], headers: Mapping[str, DataFrame] | None = None) -> DataFrame:
        return purchase_lines(w, kind, need, headers)


for _kind in KINDS:
    _register_kind(_kind)


@model("purchases_fiscal_usage_invoice")
def purchases_fiscal_usage_invoice(w: Warehouse, need: set[str]) -> DataFrame:
    return header_usage(w, "purchase_invoice_usage_pch12", need)


@model("purchases_fiscal_documents")
def purchases_fiscal_documents(w: Warehouse, need: set[str]) -> DataFrame:
    return union_bricks(w.model(f"purchases_{kind}_documents", *sorted(need)) for kind in KINDS)


@model("purchases_fiscal_lines")
def purchases_fiscal_lines(w: Warehouse, need: set[str]) -> DataFrame:
    return union_bricks(w.model(f"purchases_{kind}_lines", *sorted(need)) for kind in KINDS)
