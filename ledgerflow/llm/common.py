"""What the corpus operators share: tables, stored intermediates, the connected-component step."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import work_folder

#: A word is a run of anything but space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPE: ContextVar[str] = ContextVar("scope", default="llm")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What operators store inside is deleted at the end; write their results somewhere before.

    Outside of such a scope stored frames stay: a result that is not computed
    yet may read them.
    """
    token = _SCOPE.set(f"llm/{uuid.uuid4().hex}")
    folder = f"{work_folder(spark)}/{_SCOPE.get()}"
    try:
        yield
    finally:
        _SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back: lost executors do not recompute it."""
    path = f"{work_folder(df.sparkSession)}/{_SCOPE.get()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_rows(docs: DataFrame, **keys: Column) -> DataFrame:
    """Every row as one struct `row` beside the named keys, so that its columns clash with none of an operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(name) for name, c in keys.items()])


def columns_of(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns of `whole_rows` again."""
    return rows.select(*[F.col("row")[c].alias(c) for c in names])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join whose left side may hold hot keys and whose right side is unique on the key.

    Both sides get the key's hash as a second join column. It is new to either
    side, so Spark shuffles both for this join alone and its skew handling may
    split a hot key of the left side. Sizes are estimated badly behind Python
    operators, so neither side is broadcast on an estimate.
    """
    salted = F.xxhash64(F.lit("join"), F.col(key))
    renamed = right.withColumnRenamed(key, f"{key}__right").withColumn("h__right", F.xxhash64(F.lit("join"), F.col(f"{key}__right")))
    marked = left.withColumn("h__left", salted)
    joined = marked.join(renamed.hint("merge"), F.col("h__left").eqNullSafe(F.col("h__right")) & F.col(key).eqNullSafe(F.col(f"{key}__right")), how)
    return joined.drop("h__left", "h__right", f"{key}__right")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): one row (node, root) per node.

    root is the smallest node of the component. Rounds of large star and small
    star until a round changes nothing; every round is stored, so the lineage
    stays short and nothing but a row count and a checksum reaches the driver.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    pairs = stored(pairs)
    mark = _checksum(pairs)
    while mark[0]:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = hot_join(both, low, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = hot_join(large, low, "hi")
        small = small.select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct("hi", F.col("m").alias("lo")))).alias("e"))
        small = small.where("e.hi <> e.lo").select("e.hi", "e.lo").distinct()
        pairs = stored(small)
        now = _checksum(pairs)
        if now == mark:
            break
        mark = now
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        pairs.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )


def _checksum(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
    return int(row["n"]), int(row["s"])
