"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# settings the plans rely on; a cluster's own values win where they are set
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # call-site capture costs milliseconds per expression while a plan is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cpus: int = 8, **settings: str) -> SparkSession:
    """Local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("ledgerflow")
    builder = builder.config("spark.sql.shuffle.partitions", str(cpus)).config("spark.driver.memory", "8g")
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 256 << 20) -> int:
    """Shuffle partitions for a run: about `target_bytes` each, at least three per core.

    Adaptive execution merges what turns out smaller, so the estimate errs on
    the high side.
    """
    return max(3 * cores, -(-input_bytes // target_bytes))


# whether a query's shuffle files go with its end, or wait until the driver's JVM has collected the query
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffles of a query that is made and run within this block give their disk back when it ends."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def shared_folder(spark: SparkSession, default: str | None = None) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    `default` is used only where the session names none, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", default)
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set: no shared folder for state")
    return folder.rstrip("/")


_OWN: list[str] = []


def work_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is set and everything runs in this process, a folder of its own."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return shared_folder(spark)
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        return shared_folder(spark)  # raises: a local folder of one machine is of no use to the others
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="ledgerflow-"))
    return _OWN[0]
