"""Daily flow: a day comes out once it is closed, and comes out again if rows come late."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.sources.sinks import append_days, current, publish, stored_days


def closed_day_flow(
    rows: DataFrame, time: str, keys: Sequence[str], amount: str, lateness: str = "0 seconds", as_of: Column | None = None
) -> DataFrame:
    """Daily sum and count per key; works on a batch frame and on a stream.

    A batch frame gives the days before `as_of`, the open day (all days, if none
    is named). On a stream in append mode a day is emitted after the watermark
    passes its end, and rows for an emitted day are dropped; `start_daily_close`
    keeps them.
    """
    if rows.isStreaming:
        rows = rows.withWatermark(time, lateness)
    elif as_of is not None:
        rows = rows.where(F.col(time).cast("date") < as_of)
    return (
        rows.groupBy(F.window(time, "1 day").alias("_day"), *keys)
        .agg(F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("row_count"))
        .select(F.col("_day.start").cast("date").alias("date"), *keys, "amount", "row_count")
    )


def _batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches under a folder with their `_batch` and `_day`; empty where there is none."""
    full = T.StructType([*schema.fields, T.StructField("_batch", T.LongType()), T.StructField("_day", T.DateType())])
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def start_daily_close(
    rows: DataFrame, folder: str, checkpoint: str, time: str, keys: Sequence[str], amount: str, late_days: int = 0
) -> StreamingQuery:
    """Publish closed days from a stream, row for row whole.

    A day closes once a row more than `late_days` days after it has come. Every
    batch is kept as it is, by day: rows for days that are still open under
    `rows`, rows for days already published under `late`. A batch that is
    repeated after a failure overwrites itself and publishes the same days.
    `rebuild_late_days` brings the late rows in.
    """
    columns = list(rows.columns)

    def close(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        schema = batch.select(*columns).schema
        day = F.col(time).cast("date")
        # a repeated batch must part its rows as it did the first time
        before = _closed_before(spark, folder, number)
        dated = batch.withColumn("_day", day)
        late = F.coalesce(day <= F.lit(before), F.lit(False)) if before is not None else F.lit(False)  # rows without a day stay open
        for name, part in (("late", dated.where(late)), ("rows", dated.where(~late))):
            part.write.mode("overwrite").partitionBy("_day").parquet(f"{folder}/{name}/_batch={number}")
        newest = max(stored_days(spark, f"{folder}/rows/_batch={number}"), default=None)
        if newest is None:
            return
        until = newest - dt.timedelta(days=1 + late_days)
        if before is not None and until <= before:
            return
        kept = _batches(spark, f"{folder}/rows", schema).where(F.col("_day") <= F.lit(until))
        if before is not None:
            kept = kept.where(F.col("_day") > F.lit(before))
        append_days(_flow(kept, keys, amount), f"{folder}/days", "date")
        mark = spark.createDataFrame([(until,)], "closed date")
        mark.write.mode("overwrite").parquet(f"{folder}/closed/_batch={number}")

    return rows.writeStream.foreachBatch(close).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _closed_before(spark: SparkSession, folder: str, number: int) -> dt.date | None:
    """The newest day that was closed before a batch."""
    marks = _batches(spark, f"{folder}/closed", T.StructType([T.StructField("closed", T.DateType())]))
    return marks.where(F.col("_batch") < number).agg(F.max("closed")).first()[0]


def _flow(rows: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    return rows.groupBy(F.col("_day").alias("date"), *keys).agg(F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("row_count"))


def rebuild_late_days(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], amount: str) -> list[dt.date]:
    """Publish the days anew that got late rows since the last rebuild; returns them.

    Only the partitions of those days are read and replaced. The newest batch
    that was looked at is kept after the days are written, so a failed rebuild
    is repeated in full.
    """
    late = _batches(spark, f"{folder}/late", schema)
    try:
        seen = current(spark, f"{folder}/rebuilt").first()[0]
    except FileNotFoundError:
        seen = -1
    waiting = late.where(F.col("_batch") > seen)
    newest = waiting.agg(F.max("_batch")).first()[0]
    if newest is None:
        return []
    days = sorted(r[0] for r in waiting.select("_day").distinct().collect())  # as many as the calendar has
    whole = _batches(spark, f"{folder}/rows", schema).unionByName(late).where(F.col("_day").isin(*days))
    append_days(_flow(whole, keys, amount), f"{folder}/days", "date")
    publish(spark.createDataFrame([(newest,)], "batch long"), f"{folder}/rebuilt")
    return days
