"""Ledger and outgoing payments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import codes
from ledgerflow.operators.joins import lookup
from ledgerflow.operators.latest import latest_per_key
from ledgerflow.operators.skew import join_lines_to_headers
from ledgerflow.plans.common import with_branch, with_partner
from ledgerflow.plans.sales import newest_versions, translated
from ledgerflow.plans.warehouse import Warehouse, model


@model("finance_journal_entries")
def finance_journal_entries(w: Warehouse, need: set[str]) -> DataFrame:
    """Ledger lines with their entry header, both accounts and the partner.

    Date and type come from the header; a line's own copies are dropped.
    """
    lines = latest_per_key(
        w.stage("journal_entry_lines_jdt1"), ["transaction_id", "line_number"],
        "_ingested_at", "debit", "credit",
    ).drop("reference_date", "transaction_type")
    headers = latest_per_key(
        w.stage("journal_entry_ojdt"), ["transaction_id"], "_ingested_at", "reference_date", "historical"
    )
    theirs = {
        "reference_date": F.col("reference_date"), "transaction_type": F.col("transaction_type"),
        "historical": F.lower("historical"), "document_reference": F.col("document_reference"),
    }
    wanted = [c.alias(name) for name, c in theirs.items() if name in need]
    # headers are unique on the key: unless a column of theirs is asked for, the join could change nothing
    df = join_lines_to_headers(lines, headers.select("transaction_id", *wanted), ["transaction_id"], "left") if wanted else lines
    accounts = w.stage("chart_of_accounts_oact")
    for key, label in (("ledger_account", "account_name"), ("offset_account", "offset_account_name")):
        df = lookup(df, accounts, {key: "account_code"}, {label: F.lower("account_name")}, need)
    names = ("partner_name", "partner_type", "group_code", "group_name")
    return with_partner(w, df, "partner_code", need, **{c: c for c in names})


@model("finance_payments")
def finance_payments(w: Warehouse, need: set[str]) -> DataFrame:
    rows = newest_versions(w.stage("outgoing_payment_ovpm")).drop("partner_name")
    rows = translated(rows, {"payment_type": codes.PAYMENT_TYPE, "canceled": codes.CANCELED})
    rows = rows.withColumn("historical", F.lower("historical"))
    names = (
        "partner_name", "partner_type", "group_code", "group_name",
        "cpf_cnpj_official", "cpf_cnpj_normalized",
    )
    rows = with_partner(w, rows, "partner_code", need, **{c: c for c in names})
    return with_branch(w, rows, need)
