"""Keeping stored tables up to date: shared layers, the daily fact and the bridge.

Tables live in the cluster's shared folder, so lost executors and a restarted
driver find them; a stored table also ends the lineage of whatever reads it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import predicates
from ledgerflow.plans.common import salesperson_bridge_step
from ledgerflow.plans.marts import daily_movement
from ledgerflow.plans.warehouse import Warehouse
from ledgerflow.sources.sinks import append_days, current, last_day, publish

# models that several marts read; later names read earlier ones
SHARED = (
    "partner", "item", "warehouse", "standardized_store", "salesperson_bridge",
    "sales_invoice_documents", "sales_return_documents", "sales_goals",
)


def store_models(w: Warehouse, folder: str, names: Sequence[str] = SHARED) -> None:
    """Publish models and let later ones read the stored tables."""
    for name in names:
        w.use(name, publish(w.model(name), f"{folder}/{name}"))


def refresh_daily_movement(w: Warehouse, spark: SparkSession, path: str) -> DataFrame:
    """Append the closed days after the last stored one, and rebuild the stored days that got movements since.

    Days are dirty where a movement was loaded after the newest load stamp that
    the last refresh saw. Whole days are replaced, and the stamp is kept after
    the days are written, so a run that fails on the way is repeated.
    """
    since, marks = last_day(spark, path, "date"), f"{path}_loaded"
    loads = w.model("inventory_movements", "movement_date", "_ingested_at")
    newest = loads.where(predicates.closed_day(F.col("movement_date"), w.params.as_of)).agg(F.max("_ingested_at").alias("loaded"))
    if since is None:
        append_days(w.model("fact_daily_inventory_movement"), path, "date")
    else:
        append_days(daily_movement(w, since, dirty_days(loads, current(spark, marks).first()["loaded"], since)), path, "date")
    publish(newest, marks)
    return spark.read.parquet(path).drop("_day")


def dirty_days(loads: DataFrame, seen: dt.datetime | None, until: dt.date) -> list[dt.date]:
    """Days up to `until` with rows loaded after `seen`; no more than the calendar has days."""
    late = loads.where(F.col("movement_date") <= F.lit(until))
    if seen is not None:
        late = late.where(F.col("_ingested_at") > F.lit(seen.isoformat(sep=" ")).cast("timestamp_ntz"))
    return sorted(r[0] for r in late.select("movement_date").distinct().collect())


def refresh_bridge(w: Warehouse, spark: SparkSession, path: str) -> DataFrame:
    """First load of the bridge, or one forward run on the stored state."""
    try:
        state = salesperson_bridge_step(w, current(spark, path))
    except FileNotFoundError:
        state = w.model("salesperson_bridge")
    return publish(state, path)
