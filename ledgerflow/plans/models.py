"""Importing this module registers every model."""

from ledgerflow.plans import common, finance, inventory, marts, purchases, sales
from ledgerflow.plans.warehouse import BUILDERS, Params, Warehouse

__all__ = ["BUILDERS", "Params", "Warehouse", "common", "finance", "inventory", "marts", "purchases", "sales"]
