"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so a key that holds a large share of the rows sends at
    most one row per task and the reducing side never sees the whole group.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    """Newest version per key; `newest` names the deciding columns in order.

    Extra columns after the load stamp make the order total, so a rerun keeps
    the same rows.
    """
    return first_per_key(df, keys, [F.col(c).desc() for c in newest])
