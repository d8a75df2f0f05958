"""Business filters as boolean Columns, with SQL three-valued logic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import blank_to_null, is_retired

# fixed values of the business rules
INTERCOMPANY_GROUP = 111
CONTRIBUTION_BRANCH = 9
SALES_USAGES = (9, 10, 20, 22, 37, 46, 56)
RETURN_USAGE = 24
COMMERCIAL_PURCHASE_USAGE = 3
FREIGHT_EXPENSE = 1
EXCLUDED_SALESPEOPLE = (184, 188)
DISCONTINUED_GOALS = "FRANQUIA"


def sales_visible(partner_shown: Column, group_code: Column, branch_id: Column) -> Column:
    """Shown partner outside the intercompany group, or any group in the contribution branch."""
    return (partner_shown == "yes") & (
        (group_code != INTERCOMPANY_GROUP) | (branch_id == CONTRIBUTION_BRANCH)
    )


def purchases_visible(canceled: Column, partner_shown: Column, group_code: Column) -> Column:
    return (canceled == "no") & (partner_shown == "yes") & (group_code != INTERCOMPANY_GROUP)


def sales_usage(usage_id: Column) -> Column:
    return usage_id.isin(*SALES_USAGES)


def return_header_usage(main_usage_id: Column) -> Column:
    return main_usage_id == RETURN_USAGE


def not_canceled_return(document_type: Column, canceled: Column) -> Column:
    return ~((document_type == "return") & (canceled != "no"))


def force_display(document_shown: Column, otherwise: Column) -> Column:
    """A flagged document enters whatever the other filters say."""
    return (document_shown == "yes") | otherwise


def commercial_purchase(usage_id: Column) -> Column:
    return usage_id == COMMERCIAL_PURCHASE_USAGE


def valid_salesperson(code: Column) -> Column:
    return code >= 0


def bridge_salesperson(code: Column, name: Column, store: Column) -> Column:
    return (
        valid_salesperson(code)
        & ~is_retired(name)
        & ~code.isin(*EXCLUDED_SALESPEOPLE)
        & blank_to_null(store).isNotNull()
    )


def listed_goal(date: Column, salesperson: Column, min_year: int) -> Column:
    return (
        (F.year(date) >= min_year)
        & salesperson.isNotNull()
        & ~salesperson.startswith(DISCONTINUED_GOALS)
    )


def resolved_goal(date: Column, salesperson_code: Column, min_year: int) -> Column:
    return (F.year(date) >= min_year) & salesperson_code.isNotNull()


def closed_day(day: Column, as_of: dt.date) -> Column:
    return day < F.lit(as_of)


def active_warehouse(inactive: Column) -> Column:
    return inactive != "yes"


def freight_expense(expense_code: Column) -> Column:
    return expense_code == FREIGHT_EXPENSE
