"""Publishing frames: views, versioned tables, appends, bucketed tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Live view, no storage."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a table, oldest first; unfinished writes do not count."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    done = [n for n in names if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(n for n in done if n.startswith("v"))


def publish(df: DataFrame, path: str) -> DataFrame:
    """Replace a table atomically: write a new version beside the old one.

    Readers take the newest version that carries the success marker, so a
    failed or running write leaves the old data in place, and a plan that
    reads the current version may write the next.
    """
    spark = df.sparkSession
    last = _versions(spark, path)
    number = int(last[-1][1:]) + 1 if last else 0
    df.write.mode("overwrite").parquet(f"{path}/v{number:08d}")
    return current(spark, path)


def current(spark: SparkSession, path: str) -> DataFrame:
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/{versions[-1]}")


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest complete versions of a published table."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in _versions(spark, path)[: -max(keep, 1)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


def append_days(df: DataFrame, path: str, day: str) -> None:
    """Append rows to a table partitioned by day; a rerun of a day replaces that day only."""
    (
        df.withColumn("_day", F.col(day))
        # one day goes to few files, and a very large day to several
        .hint("rebalance", "_day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_day")
        .parquet(path)
    )


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days of a table partitioned by day, from its folder names; none where there is no table."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()] if fs.exists(root) else []
    days = [n.partition("=")[2] for n in names if n.startswith("_day=")]
    return sorted(dt.date.fromisoformat(d) for d in days if d != "__HIVE_DEFAULT_PARTITION__")


def last_day(spark: SparkSession, path: str, day: str) -> dt.date | None:
    """Newest loaded day, None where nothing is loaded; no file is read."""
    return max(stored_days(spark, path), default=None)


def bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Table bucketed and sorted on its join key: joins on it need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)
