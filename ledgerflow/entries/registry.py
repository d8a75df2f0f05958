"""All registered queries; importing this module registers them."""

from ledgerflow.entries import model_sql  # noqa: F401  isort: skip  (check SQL of the models comes first)
from ledgerflow.entries import expressions, loads, models, relational  # noqa: F401
from ledgerflow.entries.base import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
