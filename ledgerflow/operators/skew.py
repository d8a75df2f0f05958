"""Joins that survive a key holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_lines_to_headers(lines: DataFrame, headers: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join many lines to their one header row, whatever share of the lines a key holds.

    Adaptive skew handling splits a hot key only between two shuffles made for
    the join itself, which a header side deduplicated on the key would not get.
    So a bit of the keys' hash joins as one more column: neither side is
    partitioned by it yet, both are shuffled for this join and a hot key's
    lines are dealt over as many tasks as their bytes need. A bit compresses,
    where all 64 would be a fifth of a narrow line.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a hot key's header is copied, so only inner and left joins are right, not {how}")
    keys = list(keys)
    split = F.xxhash64(F.lit("lines"), *keys).bitwiseAND(F.lit(1))
    joined = lines.withColumn("_split", split).join(headers.withColumn("_split", split), [*keys, "_split"], how)
    return joined.drop("_split")


def _flagged(rows: DataFrame, known: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> tuple[DataFrame, str]:
    """The rows with a flag where `known` has their key; the right side is one row per key."""
    pairs = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    taken = set(rows.columns)
    flag = next(n for n in (f"_known{i}" for i in range(len(taken) + 1)) if n not in taken)
    renamed = {ours: f"{flag}_{i}" for i, ours in enumerate(pairs)}
    distinct = known.select(*(F.col(theirs).alias(renamed[ours]) for ours, theirs in pairs.items())).distinct()
    distinct = distinct.withColumn(f"{flag}_h", F.xxhash64(F.lit("known"), *renamed.values())).withColumn(flag, F.lit(True))
    split = F.xxhash64(F.lit("known"), *(F.col(f"`{c}`") for c in pairs))
    same = split == F.col(f"{flag}_h")
    for ours, theirs in renamed.items():
        same = same & (F.col(f"`{ours}`") == F.col(theirs))
    return rows.join(distinct, same, "left"), flag


def semi_join(rows: DataFrame, known: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows whose key occurs in `known` (EXISTS); a NULL in a key matches nothing.

    `keys` names the key columns, or maps ours to theirs. The right side is
    reduced to distinct keys, which combines on the map side, so a key that
    repeats there is shuffled once per task. The keys' hash is a join column of
    its own, so both sides are shuffled for this join and adaptive execution may
    split a hot key of the left side.
    """
    joined, flag = _flagged(rows, known, keys)
    return joined.where(F.col(flag).isNotNull()).select(*(F.col(f"`{c}`") for c in rows.columns))


def anti_join(rows: DataFrame, known: DataFrame, keys: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Rows whose key does not occur in `known` (NOT EXISTS): a NULL in a key keeps the row. See `semi_join`."""
    joined, flag = _flagged(rows, known, keys)
    return joined.where(F.col(flag).isNull()).select(*(F.col(f"`{c}`") for c in rows.columns))
