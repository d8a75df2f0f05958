"""Code-to-label translation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: code lists of the ERP and their labels
DOCUMENT_STATUS = {"O": "open", "C": "closed"}
INSTALLMENT_STATUS = {"O": "open", "C": "closed"}
CANCELED = {"N": "no", "Y": "canceled", "C": "reversal"}
YES_NO = {"Y": "yes", "N": "no"}
SIM_NAO = {"S": "yes", "N": "no"}
MADE_TO_ORDER = {"S": "yes", "Y": "yes", "N": "no"}
PARTNER_TYPE = {"C": "customer", "S": "supplier", "L": "lead"}
PAYMENT_TYPE = {"A": "account", "C": "customer", "S": "supplier"}
LOAD_KIT = {"N": "retail", "S": "wholesale", "P": "unclassified"}
LOAD_KIT_QUOTE = {"N": "retail", "S": "wholesale", "P": None}
FINANCE_VALIDATED = {"N": "not validated", "S": "validated", "P": "pending"}
TRIANGULATION = {"C": "to confirm", "S": "yes", "N": "no"}
PRESALE_CHANNEL = {
    "N": "no",
    "P": "crm",
    "PS": "crm steel frame",
    "PD": "crm drywall",
    "PP": "crm floors",
    "PA": "crm acoustic",
    "PE": "crm frames",
    "PQ": "crm mortar",
    "I": "internal (google)",
}
MOVEMENT_TYPE = {
    13: "sales_invoice",
    14: "customer_return",
    15: "delivery",
    16: "delivery_return",
    18: "purchase_invoice",
    19: "supplier_return",
    20: "goods_receipt",
    21: "receipt_return",
    58: "inventory_update",
    59: "manual_inflow",
    60: "manual_outflow",
    67: "transfer",
    68: "production_order",
    69: "import_costs",
    132: "correction_invoice",
    162: "revaluation",
    10000071: "inventory_count",
    310000001: "initial_balance",
}
JOB_RESULT = {1: "success", 0: "failed", 2: "retry", 3: "canceled", 4: "running"}


def _cases(c: Column, labels: Mapping) -> Column:
    chain = F
    for code, label in labels.items():
        chain = chain.when(c == code, F.lit(label))
    return chain


def translate_code(c: Column, labels: Mapping[str, str | None]) -> Column:
    """Label of a code; unknown codes come back lowercased, NULL stays NULL."""
    return _cases(c, labels).otherwise(F.lower(c))


def movement_type_slug(c: Column) -> Column:
    return _cases(c, MOVEMENT_TYPE).otherwise(F.concat(F.lit("type_"), c.cast("string")))


def job_result(c: Column) -> Column:
    return _cases(c, JOB_RESULT).otherwise("?")
