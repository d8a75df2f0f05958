"""Unions of per-type bricks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_bricks(bricks: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, bricks)


def union_labelled(parts: Mapping[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL with a literal discriminator column naming each part."""
    return union_bricks(df.withColumn(label, F.lit(name)) for name, df in parts.items())
