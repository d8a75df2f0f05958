"""Streaming upsert: the newest version per key of a change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerflow.operators.latest import latest_per_key
from ledgerflow.sources.store import Store, VersionConflict


def newest_of(state: DataFrame | None, changes: DataFrame, keys: Sequence[str], *newest: str) -> DataFrame:
    """State after a batch of changes: newest row per key of both.

    Each side is reduced to one row per key and task before the shuffle, and
    replaying a batch gives the same state.
    """
    rows = changes if state is None else state.unionByName(changes)
    return latest_per_key(rows, keys, *newest)


def start_upsert(
    changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], *newest: str
) -> StreamingQuery:
    """Append the newest row per key of every batch to the change log at `path`.

    A batch costs what it carries, whatever the size of the table; reading the
    log with `newest_state` gives one row per key.  A batch replayed after a
    failure only repeats rows, which the reading side collapses.
    """

    def append(batch: DataFrame, _: int) -> None:
        latest_per_key(batch, keys, *newest).write.mode("append").parquet(path)

    return (
        changes.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_state(spark: SparkSession, path: str, keys: Sequence[str], *newest: str) -> DataFrame:
    """Current table of a change log; publish it now and then to start a shorter log."""
    return latest_per_key(spark.read.parquet(path), keys, *newest)


def start_upsert_table(changes: DataFrame, store: Store, name: str, checkpoint: str, stream: str = "", tries: int = 5) -> StreamingQuery:
    """Lay the newest rows of every batch beside a stored table as one more segment.

    A batch that is replayed after a failure is known by its number and left
    out. `store.compact` moves segments into the table's buckets meanwhile or
    later, and readers keep the version they hold.
    """

    def append(batch: DataFrame, number: int) -> None:
        for left in range(tries, 0, -1):
            change = store.change()
            try:
                if change.append_segment(name, batch, number, stream):
                    change.commit()
                return
            except VersionConflict:
                if left == 1:
                    raise

    return changes.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
