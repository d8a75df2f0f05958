"""Stored tables: shared layers, the incremental daily fact and the bridge."""

from __future__ import annotations

import dataclasses
import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.entries.base import DRIVER_PARAMS, warehouse
from ledgerflow.plans.models import Warehouse
from ledgerflow.plans.refresh import refresh_bridge, refresh_daily_movement, store_models
from ledgerflow.session import shuffle_partitions


def test_facts_from_stored_layers_equal_direct_ones(spark, sf_dir, tmp_path):
    direct = warehouse(spark, sf_dir)
    stored = warehouse(spark, sf_dir)
    store_models(stored, str(tmp_path), ("partner", "salesperson_bridge", "sales_goals"))
    assert rows(stored.model("fact_goals")) == rows(direct.model("fact_goals"))
    columns = ("document_id", "line_number", "store_code", "gross_profit")
    assert rows(stored.model("fact_sales", *columns)) == rows(direct.model("fact_sales", *columns))


def test_daily_movement_grows_by_closed_days(spark, sf_dir, tmp_path):
    path = str(tmp_path / "daily")
    early, later = (dataclasses.replace(DRIVER_PARAMS, as_of=dt.date(1995, m, 1)) for m in (3, 4))
    first = refresh_daily_movement(warehouse(spark, sf_dir, early), spark, path)
    assert first.agg(F.max("date")).first()[0] < early.as_of
    w = warehouse(spark, sf_dir, later)
    expected = w.model("fact_daily_inventory_movement")
    assert rows(refresh_daily_movement(w, spark, path).select(*expected.columns)) == rows(expected)
    assert refresh_daily_movement(w, spark, path).count() == expected.count()  # nothing new


def test_back_dated_movement_rebuilds_its_day(spark, sf_dir, tmp_path):
    """A movement loaded later for a stored day shows up after the next refresh; other days are not rewritten."""
    path = str(tmp_path / "daily")
    params = dataclasses.replace(DRIVER_PARAMS, as_of=dt.date(1995, 4, 1))
    base = warehouse(spark, sf_dir, params)
    first = refresh_daily_movement(base, spark, path)
    day = first.agg(F.min("date")).first()[0]
    other = first.where(F.col("date") > F.lit(day)).agg(F.min("date")).first()[0]
    untouched = sorted(p.name for p in (tmp_path / "daily" / f"_day={other}").glob("*.parquet"))

    oinm = base.raw("oinm")
    stamp = F.lit("1995-05-01 00:00:00").cast("timestamp_ntz")
    late = oinm.where(F.col("DocDate").cast("date") == F.lit(day)).limit(1).withColumn("_ingested_at", stamp).withColumn("TransNum", F.col("TransNum") + 1)
    booked = oinm.unionByName(late)
    later = Warehouse(lambda name: booked if name == "oinm" else base.raw(name), params)
    expected = later.model("fact_daily_inventory_movement")
    got = refresh_daily_movement(later, spark, path).select(*expected.columns)
    assert rows(got) == rows(expected)
    changed = got.where(F.col("date") == F.lit(day)).agg(F.sum("movement_count")).first()[0]
    assert changed == base.model("fact_daily_inventory_movement").where(F.col("date") == F.lit(day)).agg(F.sum("movement_count")).first()[0] + 1
    assert sorted(p.name for p in (tmp_path / "daily" / f"_day={other}").glob("*.parquet")) == untouched


def test_bridge_state_survives_a_run_without_changes(spark, sf_dir, tmp_path):
    path = str(tmp_path / "bridge")
    w = warehouse(spark, sf_dir)
    first = rows(refresh_bridge(w, spark, path))
    assert rows(refresh_bridge(w, spark, path)) == first == rows(w.model("salesperson_bridge"))


def test_shuffle_partitions():
    assert shuffle_partitions(0, 8) == 24
    assert shuffle_partitions(100 << 40, 4000) == 409600
