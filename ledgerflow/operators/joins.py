"""Join operators of the warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import fold
from ledgerflow.operators.skew import join_lines_to_headers

OPEN_END = dt.date(9999, 12, 31)


def lookup(
    df: DataFrame,
    dimension: DataFrame,
    keys: Mapping[str, str],
    columns: Mapping[str, Column],
    need: set[str] | None = None,
) -> DataFrame:
    """Left-join attributes of a dimension that is unique on its key.

    keys maps df column -> dimension column, columns maps output name ->
    expression over the dimension.  When none of the outputs is needed the
    join is left out altogether: it could neither add nor drop rows.
    """
    wanted = {name: c for name, c in columns.items() if need is None or name in need}
    if not wanted:
        return df
    right = dimension.select(
        *(F.col(theirs).alias(ours) for ours, theirs in keys.items()),
        *(c.alias(name) for name, c in wanted.items()),
    )
    return df.join(right, list(keys), "left")


def code_or_name(master: DataFrame, code: str, name: str) -> DataFrame:
    """Resolver entry -> code, where an entry is a code or a name.

    A name that equals a code, or a repeated name, gives several rows for one
    entry; a join on it then repeats the document, as the source does.
    """
    by_code = master.select(F.col(code).alias("entry"), F.col(code).alias("resolved"))
    by_name = master.select(F.col(name).alias("entry"), F.col(code).alias("resolved"))
    return by_code.unionByName(by_name)


def match_key(c: Column) -> Column:
    """Join key for names: case, accents and trailing blanks do not count."""
    return fold(F.rtrim(c))


def temporal_left_join(
    left: DataFrame,
    periods: DataFrame,
    name: str,
    day: str,
    start: str,
    end: str,
) -> DataFrame:
    """Left join on equal names (case- and accent-insensitive) and day within [start, end].

    `periods` must not share other column names with `left`.  A NULL end is an
    open period.  The name equality keeps the join hashed on the name, with
    the period as an extra condition.
    """
    right = periods.withColumn("_name_key", match_key(F.col(name))).drop(name)
    ours = left.withColumn("_left_key", match_key(F.col(name)))
    inside = (F.col(day) >= F.col(start)) & (
        F.col(day) <= F.coalesce(F.col(end), F.lit(OPEN_END))
    )
    joined = ours.join(right, (F.col("_left_key") == F.col("_name_key")) & inside, "left")
    return joined.drop("_left_key", "_name_key")


#: periods that start in one bucket of one key before the bucket is split
BUCKET_PERIODS = 1000


def overlapping_periods(
    periods: DataFrame, keys: Sequence[str], start: str, end: str, width_days: int = 366, limit: int = BUCKET_PERIODS
) -> DataFrame:
    """Pairs of periods of one key that overlap: (keys, start_a, end_a, start_b, end_b).

    b starts inside a, and after a.  Every start day falls in one time bucket
    and every period is listed under the buckets it reaches, so only periods
    of the same key *and* time bucket meet; a key with a long history is
    spread over its buckets instead of being compared with itself in full. A
    bucket in which more than `limit` periods start is split into narrower
    ones, down to single days, where all that meet do overlap. Open periods
    reach no further than the last start day on record.
    """
    keys = list(keys)
    days = lambda c: F.datediff(c, F.lit(dt.date(1970, 1, 1)))
    bucket = lambda c: F.floor(days(c) / width_days)
    last_start = periods.agg(F.max(start)).scalar()
    b = periods.select(*keys, F.col(start).alias("start_b"), F.col(end).alias("end_b"))
    b = b.where(F.col("start_b").isNotNull()).withColumn("_bucket", bucket(F.col("start_b")))
    place = [*keys, "_bucket"]
    counts = b.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    crowded = counts.select(*place, F.least(F.ceil(F.col("_n") / limit), F.lit(width_days)).alias("_parts"))
    # which part of its bucket a day is in
    part = lambda c: F.floor((days(c) - F.col("_bucket") * width_days) * F.col("_parts") / width_days)

    def placed(rows: DataFrame) -> DataFrame:
        return join_lines_to_headers(rows, crowded, place, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("bigint")))

    a = periods.select(*keys, F.col(start).alias("start_a"), F.col(end).alias("end_a")).withColumn(
        "_reach", F.least(F.coalesce(F.col("end_a"), F.lit(OPEN_END)), last_start)
    )
    a = a.where(F.col("_reach") > F.col("start_a")).withColumn(
        "_bucket", F.explode(F.sequence(bucket(F.col("start_a")), bucket(F.col("_reach"))))
    )
    first = F.when(bucket(F.col("start_a")) == F.col("_bucket"), part(F.col("start_a"))).otherwise(F.lit(0).cast("bigint"))
    final = F.when(bucket(F.col("_reach")) == F.col("_bucket"), part(F.col("_reach"))).otherwise(F.col("_parts") - 1)
    a = placed(a).withColumn("_part", F.explode(F.sequence(first, final))).drop("_parts")
    b = placed(b).withColumn("_part", part(F.col("start_b"))).drop("_parts")
    pairs = a.join(b, [*place, "_part"]).where(
        (F.col("start_b") > F.col("start_a"))
        & (F.col("start_b") <= F.col("_reach"))
        & (F.col("start_a") <= F.coalesce(F.col("end_b"), F.lit(OPEN_END)))
    )
    return pairs.select(*keys, "start_a", "end_a", "start_b", "end_b")
