"""Reading the driver's parquet tables and shaping them into raw ERP frames."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.skew import join_lines_to_headers
from ledgerflow.sources.raw_sql import LINE_KEYS, LINE_TABLES, RAW_SQL

ALL_PARTITIONS = (1 << 31) - 1


class DriverTables:
    """The driver's parquet tables and the raw ERP tables over them, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def raw(self, name: str) -> DataFrame:
        text = RAW_SQL[name]
        used = set(re.findall(r"{(\w+)}", text))
        return self.spark.sql(text, **{t: self.table(t) for t in used})

    def labelled(
        self, name: str, labels: Mapping[str, DataFrame], headers: Mapping[str, tuple[str, DataFrame]] | None = None
    ) -> DataFrame | None:
        """The raw table with the other columns of frames left-joined to it by a raw column each, or None.

        Of `headers`, by a raw column each and with the name they have for it, a line has to have one.

        A line of a raw table is up to three times as wide as the driver's line it is
        made from, so the joins move the driver's lines and the SELECT shapes them
        behind the last shuffle.
        """
        headers = headers or {}
        if name not in LINE_TABLES or not labels.keys() | headers.keys() <= LINE_KEYS.keys():
            return None
        lines = self.table("lineitem")
        if any(LINE_KEYS[key] not in lines.columns for key in headers):
            return None
        for key, (theirs, header) in headers.items():
            ours = LINE_KEYS[key]
            lines = join_lines_to_headers(lines.withColumnRenamed(ours, theirs), header, [theirs]).withColumnRenamed(theirs, ours)
        for key, label in labels.items():
            ours = LINE_KEYS[key]
            if ours not in lines.columns:  # as a column, or every comparison of the join's sort computes it
                lines, ours = lines.withColumn("_ours", F.expr(ours)), "_ours"
            lines = lines.join(label, F.col(ours) == F.col(key), "left").drop("_ours", key)
        joined = (*headers.values(), *labels.items())
        carried = "".join(f"l.`{c}`, " for key, frame in joined for c in frame.columns if c != key)
        shaped = self.spark.sql(RAW_SQL[name].replace("SELECT ", f"SELECT {carried}", 1), lineitem=lines)
        # merges no partitions; without it join, SELECT and staging are one generated method that the JVM leaves uncompiled
        return shaped.coalesce(ALL_PARTITIONS)
