"""Signs, guarded ratios and statuses."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.contract import MONEY


TOTAL = "decimal(38,6)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def total(c: Column) -> Column:
    """A sum of amounts: its digits grow with the number of rows."""
    return c.cast(TOTAL)


def _below(digits: int, *columns: Column) -> Column:
    limit = F.lit(10**digits).cast("decimal(20,0)")
    return reduce(operator.and_, (F.abs(c) < limit for c in columns))


def product(a: Column, b: Column) -> Column:
    """Product of two amounts, brought back to the money type.

    Operands below 10^12 are narrowed to 18 digits first and give the exact
    product: Spark would otherwise cut the scale of a 40-digit product before
    the final rounding. Larger ones are multiplied as they are.
    """
    exact = a.cast("decimal(18,6)") * b.cast("decimal(18,6)")
    return F.when(_below(12, a, b), money(exact)).otherwise(money(a.cast(MONEY) * b.cast(MONEY)))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else NULL.

    Both sides are brought to the money type first, which leaves the quotient
    enough decimals to be rounded once; totals that do not fit are divided as
    they are. A zero is not divided at all.
    """
    narrow = money(numerator) / money(denominator)
    wide = total(numerator) / total(denominator)
    ratio = F.when(numerator == 0, F.lit(0).cast(TOTAL)).when(_below(14, numerator, denominator), narrow.cast(TOTAL)).otherwise(wide.cast(TOTAL))
    return F.when(denominator > 0, ratio.cast(MONEY))


def sales_sign(document_type: Column, canceled: Column) -> Column:
    reversal = canceled == "reversal"
    is_return = document_type == "return"
    return F.when(is_return & reversal, 1).when(is_return | reversal, -1).otherwise(1)


def payment_status(paid: Column, total: Column) -> Column:
    return F.when(paid >= total, "paid").when(paid > 0, "partial").otherwise("open")


def movement_direction(inflow: Column, outflow: Column) -> Column:
    return (
        F.when((inflow > 0) & (outflow == 0), "inflow")
        .when((outflow > 0) & (inflow == 0), "outflow")
        .when((inflow == 0) & (outflow == 0), "value_adjustment")
        .otherwise("mixed")
    )


def sentinel_to_null(c: Column, sentinel: int = -1) -> Column:
    return F.nullif(c, F.lit(sentinel))
