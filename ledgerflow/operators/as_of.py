"""The newest or largest mark up to a day, without comparing rows in pairs.

Marks (version starts, period ends) and probes (days that ask) are one stream of
events per key. A running maximum in the order of days gives every probe the best
mark so far; it runs inside time buckets, and the best of all earlier buckets of a
key, found on one row per key and bucket, starts each of them. The cost grows
with the number of events, whatever number of marks a key has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.operators.joins import OPEN_END, match_key
from ledgerflow.operators.skew import join_lines_to_headers

#: days in a bucket; a key's rows of one bucket are in one task
WIDTH_DAYS = 366
_EPOCH = dt.date(1970, 1, 1)


def best_so_far(events: DataFrame, keys: Sequence[str], day: str, mark: str, width_days: int = WIDTH_DAYS) -> DataFrame:
    """The probes among `events`, with `mark` as the largest mark of their key on or before their day.

    A row with a mark is a mark, one without is a probe. Marks may be structs;
    they compare field by field. NULL keys are one key, a NULL day is earlier
    than all others.
    """
    keys = list(keys)
    bucket = F.coalesce(F.floor(F.date_diff(F.col(day), F.lit(_EPOCH)) / width_days), F.lit(-(1 << 40)))
    placed = events.withColumn("_bucket", bucket)
    # one row per key and bucket; a key has at most as many as the calendar has buckets
    best = placed.groupBy(*keys, "_bucket").agg(F.max(mark).alias("_best"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    seeds = best.withColumn(mark, F.max("_best").over(earlier)).where(F.col(mark).isNotNull())
    rows = placed.withColumn("_kind", F.when(F.col(mark).isNull(), 2).otherwise(1))
    rows = rows.unionByName(seeds.select(*keys, "_bucket", mark, F.lit(0).alias("_kind")), allowMissingColumns=True)
    # seeds first, then by day, marks of a day before its probes
    order = [(F.col("_kind") > 0).cast("int"), F.col(day).asc_nulls_first(), "_kind"]
    running = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(mark, F.max(mark).over(running)).where("_kind = 2").drop("_bucket", "_kind")


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    name: str,
    day: str,
    start: str,
    end: str,
    columns: Mapping[str, str],
    width_days: int = WIDTH_DAYS,
) -> DataFrame:
    """Left join to the version of a name that is valid on the row's day.

    Names match without case and accents. Versions of one name must not overlap
    (`overlap_offenders` finds those that do): then the version is the last one
    that started, if it has not ended; of several starts on one day the one that
    ends last counts. A NULL end is open. `columns` maps new names to columns of
    `versions`. Rows are reduced to distinct (name, day) before they meet the
    versions and get the answer back through a join that splits hot names.
    """
    reach = F.coalesce(F.col(end), F.lit(OPEN_END))
    mark = F.struct(F.col(start).alias("since"), reach.alias("reach"), *(F.col(c).alias(n) for n, c in columns.items()))
    marks = versions.where(F.col(start).isNotNull()).select(match_key(F.col(name)).alias("_name"), F.col(start).alias("_day"), mark.alias("_mark"))
    asked = rows.select(match_key(F.col(name)).alias("_name"), F.col(day).alias("_day")).where("_name IS NOT NULL AND _day IS NOT NULL").distinct()
    found = best_so_far(marks.where("_name IS NOT NULL").unionByName(asked, allowMissingColumns=True), ["_name"], "_day", "_mark", width_days)
    valid = found.where(F.col("_mark.reach") >= F.col("_day")).select("_name", "_day", *(F.col(f"_mark.{n}").alias(n) for n in columns))
    keyed = rows.withColumn("_name", match_key(F.col(name))).withColumn("_day", F.col(day))
    return join_lines_to_headers(keyed, valid, ["_name", "_day"], "left").drop("_name", "_day")


def overlap_offenders(periods: DataFrame, keys: Sequence[str], start: str, end: str, width_days: int = WIDTH_DAYS) -> DataFrame:
    """Periods that start while an earlier one of their key lasts: (keys, start_a, end_a, start_b, end_b).

    One row per offending period b, with the earlier period a that lasts
    longest (the later one among equals), so n nested periods give at most n
    rows. Periods of equal start are no pair. A NULL end is open. A period that
    ends before it starts offends where an earlier one covers both its days.
    """
    keys = list(keys)
    first, last = F.col(start), F.col(end)
    mark = F.struct(F.coalesce(last, F.lit(OPEN_END)).alias("reach"), first.alias("start_a"), last.alias("end_a"))
    nothing = F.lit(None)
    as_mark = F.struct(first.alias("_day"), mark.alias("_mark"), nothing.cast("date").alias("start_b"), nothing.cast("date").alias("end_b"))
    # b looks at the starts before its own and, if it is the wrong way round, not after its end
    look = F.least(F.date_sub(first, 1), last)
    as_probe = F.struct(look.alias("_day"), F.when(F.lit(False), mark).alias("_mark"), first.alias("start_b"), last.alias("end_b"))
    events = periods.where(first.isNotNull()).dropna(subset=keys).select(*keys, F.explode(F.array(as_mark, as_probe)).alias("e")).select(*keys, "e.*")
    found = best_so_far(events, keys, "_day", "_mark", width_days)
    return found.where(F.col("_mark.reach") >= F.col("start_b")).select(*keys, "_mark.start_a", "_mark.end_a", "start_b", "end_b")
