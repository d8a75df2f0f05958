"""Load strategies: each returns the target's full new state.

Watermarks are read from the target before anything is written, as one small
aggregate, and enter the source filter as literals, so they reach the scan.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.setops import union_bricks
from ledgerflow.operators.skew import anti_join, semi_join


def scan(src: DataFrame, columns: Sequence[str], predicate: str | Column | None = None) -> DataFrame:
    """Column list and filter, both pushed to the source by the optimizer."""
    return (src if predicate is None else src.where(predicate)).select(*columns)


def full_reload(src: DataFrame, columns: Sequence[str], predicate: str | Column | None = None) -> DataFrame:
    """The target becomes exactly the filtered source; publish it with `sinks.publish`."""
    return scan(src, columns, predicate)


def replace_by_key(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the target rows whose key the delta carries, then add the delta."""
    return anti_join(target, delta, keys).unionByName(delta.select(*target.columns))


def high_mark(target: DataFrame, column: str) -> Any:
    """Largest value in the target, None when it is empty."""
    return target.agg(F.max(column)).first()[0]


def upsert_by_watermark(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    watermark: str,
    floor: Column | None = None,
) -> DataFrame:
    """Source rows at or after the target's high mark replace their key; `floor` bounds the volume."""
    mark = high_mark(target, watermark)
    delta = src if floor is None else src.where(floor)
    if mark is not None:
        delta = delta.where(F.col(watermark) >= F.lit(mark))
    return replace_by_key(target, delta, keys)


@dataclass(frozen=True)
class HeaderMark:
    """High mark of a header table, captured once for the header and all its children."""

    day: Any
    second: int
    key: int
    day_column: str = "UpdateDate"
    second_column: str = "UpdateTS"
    key_column: str = "DocEntry"

    def changed(self) -> Column | None:
        """Edited after the mark, or a key above all known ones; None loads everything.

        The key branch catches new documents that carry an older edit time.
        """
        if self.day is None:
            return None
        day, second = F.col(self.day_column), F.col(self.second_column)
        return (
            (day > F.lit(self.day))
            | ((day == F.lit(self.day)) & (second > self.second))
            | (F.col(self.key_column) > self.key)
        )


def mark_row(
    target: DataFrame, day: str = "UpdateDate", second: str = "UpdateTS", key: str = "DocEntry"
) -> DataFrame:
    """One row (day, second, key): the newest edit and the largest key of the target."""
    newest = F.max(
        F.when(F.col(day).isNotNull(), F.struct(F.col(day).alias("d"), F.coalesce(F.col(second), F.lit(0)).alias("s")))
    )
    found = target.agg(newest.alias("newest"), F.max(key).alias("key"))
    return found.select(
        F.col("newest.d").alias("day"),
        F.coalesce(F.col("newest.s"), F.lit(0)).cast("int").alias("second"),
        F.coalesce(F.col("key"), F.lit(0)).cast("bigint").alias("key"),
    )


def capture_mark(
    target: DataFrame, day: str = "UpdateDate", second: str = "UpdateTS", key: str = "DocEntry"
) -> HeaderMark:
    row = mark_row(target, day, second, key).first()
    return HeaderMark(row.day, row.second, row.key, day, second, key)


def changed_rows(src: DataFrame, mark: HeaderMark) -> DataFrame:
    condition = mark.changed()
    return src if condition is None else src.where(condition)


def upsert_headers(target: DataFrame, src: DataFrame, mark: HeaderMark) -> DataFrame:
    return replace_by_key(target, changed_rows(src, mark), [mark.key_column])


def reload_children(
    target: DataFrame, src: DataFrame, header_src: DataFrame, mark: HeaderMark
) -> DataFrame:
    """Reload all children of every changed header.

    Only keys present among the reloaded children are replaced: a header that
    lost all its children at the source keeps the old ones.
    """
    key = mark.key_column
    delta = src
    if mark.day is not None:
        delta = semi_join(src, changed_rows(header_src, mark), [key])
    return replace_by_key(target, delta, [key])


def load_family(
    target: Mapping[str, DataFrame], source: Mapping[str, DataFrame], header: str
) -> dict[str, DataFrame]:
    """New state of a header table and its children under one captured mark."""
    mark = capture_mark(target[header])
    state = {header: upsert_headers(target[header], source[header], mark)}
    for child in source:
        if child != header:
            state[child] = reload_children(target[child], source[child], source[header], mark)
    return state


def append_from_last_day(target: DataFrame, src: DataFrame, day: str) -> DataFrame:
    """Replace the target's last day and append everything after it.

    A row dated in the future pins the mark: later runs then reload that day
    and see nothing before it.
    """
    mark = high_mark(target, day)
    if mark is None:
        return src.select(*target.columns)
    kept = target.where(~F.col(day).eqNullSafe(F.lit(mark)))
    return kept.unionByName(src.where(F.col(day) >= F.lit(mark)).select(*target.columns))


REPEATED_KEY = "a source key occurs more than once; name the columns that tell the newest"


def one_per_key(src: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()) -> DataFrame:
    """The source with `_src`, one row per key: the newest where an order is named, else a repeated key raises.

    Spark limits every task to two rows per key before the shuffle, and the
    rows stay dealt by the key for the join that follows. Rows that are equal
    in the named order are told apart by the hash of all their columns.
    """
    order = [*(F.col(c).desc() for c in newest), F.xxhash64(*src.columns)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = src.withColumn("_rank", rank).where(F.col("_rank") <= (1 if newest else 2))
    once = F.when(F.col("_rank") == 2, F.raise_error(F.lit(REPEATED_KEY)).cast("boolean")).otherwise(True)
    return ranked.withColumn("_src", once).drop("_rank")


def merge_upsert(
    target: DataFrame,
    src: DataFrame,
    keys: Sequence[str],
    stamp: str | None = None,
    run_ts: Column | None = None,
    newest: Sequence[str] = (),
) -> DataFrame:
    """MERGE without delete: update matches, insert the rest, keep orphans.

    Columns only the target has keep their values on a match and are NULL on
    an insert. A source key that repeats raises, or its row of the largest
    `newest` counts. A key with a NULL matches nothing, so its rows are all
    inserted. One full outer join on the key.
    """
    whole = reduce(operator.and_, (F.col(k).isNotNull() for k in keys))
    once = one_per_key(src.where(whole), keys, newest)
    theirs = once.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in src.columns if c not in keys), "_src")
    joined = target.join(theirs, list(keys), "full_outer")
    out, added = [], []
    for field in target.schema.fields:
        c = field.name
        value, new = F.col(c), F.lit(None)
        if c in src.columns:
            new = F.col(c)
            if c not in keys:
                value = F.when(F.col("_src"), F.col(f"_new_{c}")).otherwise(value)
        elif c == stamp and run_ts is not None:
            value, new = F.when(F.col("_src"), run_ts).otherwise(value), run_ts
        out.append(value.alias(c))
        added.append(new.cast(field.dataType).alias(c))
    return joined.select(*out).unionByName(src.where(~whole).select(*added))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_bricks(
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    )


def compare_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of two rounds, largest change first."""
    joined = before.withColumnRenamed("n", "after_round1").join(
        after.withColumnRenamed("n", "after_round2"), "table_name"
    )
    delta = F.col("after_round2") - F.col("after_round1")
    return joined.withColumn("delta", delta).orderBy(F.abs("delta").desc(), "table_name")


def duplicate_keys(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Number of duplicated keys per table."""
    return union_bricks(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.count(F.when(F.col("_n") > 1, 1)).alias("dups"))
        .select(F.lit(name).alias("table_name"), "dups")
        for name, (df, keys) in tables.items()
    ).orderBy(F.col("dups").desc(), "table_name")
