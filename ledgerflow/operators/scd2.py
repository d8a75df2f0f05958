"""Slowly changing dimension, type 2: closing and opening versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import blank_to_null


def scd2_apply(
    current: DataFrame,
    incoming: DataFrame,
    master: DataFrame,
    key: str,
    attribute: str,
    run_date: dt.date,
) -> DataFrame:
    """Full new state after one forward run.

    current   all versions, with valid_from / valid_to (NULL = open)
    incoming  candidate rows (same columns, validity ignored), one per key
    master    rows deciding which open versions close: a non-blank attribute
              that differs from the version's closes it the day before the run.
              Keys absent from the master, or blank there, stay open.

    Keys left without an open version get one from `incoming`, valid from the
    run date.
    """
    run_day = F.lit(run_date)
    stated = (
        master.select(key, F.trim(attribute).alias("_stated"))
        .where(blank_to_null(F.col("_stated")).isNotNull())
        # any stated value differs <=> the smallest or the largest one does
        .groupBy(key)
        .agg(F.min("_stated").alias("_low"), F.max("_stated").alias("_high"))
    )
    moved = (F.col("_low") != F.col(attribute)) | (F.col("_high") != F.col(attribute))
    closed = (
        current.join(stated, key, "left")
        .withColumn(
            "valid_to",
            F.when(F.col("valid_to").isNull() & moved, F.date_sub(run_day, 1)).otherwise(F.col("valid_to")),
        )
        .select(*current.columns)
    )
    opened = (
        incoming.join(closed.where(F.col("valid_to").isNull()).select(key), key, "left_anti")
        .withColumn("valid_from", run_day)
        .withColumn("valid_to", F.lit(None).cast("date"))
        .select(*current.columns)
    )
    return closed.unionByName(opened)
