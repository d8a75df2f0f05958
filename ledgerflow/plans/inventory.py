"""Stock snapshot and stock movements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import codes
from ledgerflow.functions.measures import guarded_ratio, movement_direction
from ledgerflow.plans.common import with_item
from ledgerflow.plans.warehouse import Warehouse, model

WAREHOUSE_PLACE = ("warehouse_name", "branch_id", "branch_name", "store_code", "store_name")


def with_warehouse(w: Warehouse, df: DataFrame, need: set[str], how: str = "left") -> DataFrame:
    used = [c for c in (*WAREHOUSE_PLACE, "inactive") if c in need]
    if not used and how == "left":
        return df
    return df.join(w.model("warehouse", "warehouse_code", *used), "warehouse_code", how)


@model("current_inventory")
def current_inventory(w: Warehouse, need: set[str]) -> DataFrame:
    return in_known_places(w, stock_rows(w), need)


def stock_rows(w: Warehouse) -> DataFrame:
    return w.stage("warehouse_stock_oitw").withColumnRenamed("average_price", "average_cost_price")


def in_known_places(w: Warehouse, stock: DataFrame, need: set[str]) -> DataFrame:
    """Stock of known items in known warehouses."""
    stock = with_item(w, stock, need, how="inner")
    place = need | ({"inactive"} if "warehouse_inactive" in need else set())
    return with_warehouse(w, stock, place, how="inner").withColumnsRenamed({"inactive": "warehouse_inactive"})


def quantity_after():
    """Stock after a movement: its value by the average price."""
    return guarded_ratio(F.col("inventory_value_after_movement"), F.col("calculated_average_price"))


@model("inventory_movements")
def inventory_movements(w: Warehouse, need: set[str]) -> DataFrame:
    rows = w.stage("inventory_movement_oinm")
    inflow, outflow = F.col("inflow_quantity"), F.col("outflow_quantity")
    rows = rows.withColumns(
        {
            "movement_quantity": inflow - outflow,
            "quantity_after_movement": quantity_after(),
            "movement_direction": movement_direction(inflow, outflow),
            "transaction_type_description": codes.movement_type_slug(F.col("transaction_type")),
        }
    )
    return with_warehouse(w, with_item(w, rows, need, "is_stockable"), need)
