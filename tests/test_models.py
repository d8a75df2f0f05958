"""Declared data tests on the built marts, and properties of their plans."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.contract import COLUMNS, column_type
from ledgerflow.sources.driver import DriverTables
from ledgerflow.entries.base import DRIVER_PARAMS, warehouse
from ledgerflow.entries.registry import QUERIES
from ledgerflow.operators import quality
from ledgerflow.plans.marts import daily_movement
from ledgerflow.plans.models import BUILDERS, Params, Warehouse

KEYS = {
    "dim_date": ["date"], "dim_item": ["item_code"], "dim_partner": ["partner_code"], "dim_employees": ["employee_code"],
    "dim_store": ["store_code"], "dim_warehouse": ["warehouse_code"],
    "fact_sales": ["document_type", "doc_entry", "line_number"], "fact_purchases": ["document_type", "doc_entry", "line_number"],
    "fact_goals": ["channel", "date", "employee_code", "original_goal_salesperson", "original_goal_store"],
    "fact_accounts_receivable": ["document_type", "doc_entry"], "fact_inventory": ["item_code", "warehouse_code"],
    "fact_daily_inventory_movement": ["date", "item_code", "warehouse_code"],
    "sales_fiscal_documents": ["document_type", "doc_entry"], "salesperson_bridge": ["salesperson_code", "store_code", "valid_from"],
    "finance_journal_entries": ["transaction_id", "line_number"], "inventory_movements": ["transaction_number"],
}


@pytest.fixture(scope="module")
def w(spark, sf_dir):
    return warehouse(spark, sf_dir)


@pytest.mark.parametrize("name", KEYS)
def test_grain(w, name):
    built = w.model(name, *KEYS[name])
    assert quality.unique_keys(built, KEYS[name]).count() == 0
    assert built.where(" OR ".join(f"{k} IS NULL" for k in KEYS[name] if k != "original_goal_store")).count() == 0


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_contract(w, name):
    types = dict(w.model(name).dtypes)
    assert list(types) == COLUMNS[name]
    assert types == {c: column_type(name, c) for c in COLUMNS[name]}


def test_enums(w):
    for model, column, values in (
        ("fact_sales", "document_type", ["invoice", "return"]),
        ("fact_accounts_receivable", "payment_status", ["paid", "partial", "open"]),
        ("dim_employees", "status", ["active", "inactive"]),
        ("dim_item", "category_code", ["product", "service", "administrative expense"]),
        ("dim_partner", "cpf_cnpj_type", ["no document", "cpf", "cnpj", "irregular"]),
    ):
        assert quality.accepted_values(w.model(model, column), column, values).count() == 0


def test_foreign_keys(w):
    sales = w.model("fact_sales", "item_code", "partner_code", "employee_code", "store_code")
    for column, parent, key in (
        ("item_code", "dim_item", "item_code"), ("employee_code", "dim_employees", "employee_code"),
        ("store_code", "dim_store", "store_code"),
    ):
        assert quality.relationships(sales, column, w.model(parent, key), key).count() == 0


def test_calendar_default_span(w):
    days = w.model("dim_date", "date", "week_start", "weekend")
    assert days.count() == 4748
    first, last = days.agg(F.min("date"), F.max("date")).first()
    assert (first, last) == (dt.date(2023, 1, 1), dt.date(2035, 12, 31))


def test_default_parameters():
    p = Params()
    assert (p.goal_min_year, p.goal_mart_min_year, p.price_list) == (2024, 2025, 100)
    assert (p.bridge_floor, p.bridge_default) == (dt.date(2025, 1, 1), dt.date(2025, 10, 1))


def test_daily_movement_increments_add_up(w):
    """Loading up to a day and then the rest gives the full history."""
    whole = w.model("fact_daily_inventory_movement")
    cut = dt.date(1999, 1, 1)
    later = daily_movement(w, since=cut).select(*whole.columns)
    earlier = whole.where(F.col("date") <= F.lit(cut))
    assert earlier.unionByName(later).exceptAll(whole).count() == 0
    assert earlier.count() + later.count() == whole.count()


def test_stored_models_feed_later_ones(spark, sf_dir, tmp_path):
    from ledgerflow.sources.sinks import publish

    w = warehouse(spark, sf_dir)
    expected = rows(w.model("dim_partner"))
    w.use("partner", publish(w.model("partner"), str(tmp_path / "partner")))
    assert rows(w.model("dim_partner")) == expected


def test_receivables_drop_invoices_without_installments(w):
    invoices = w.model("sales_invoice_documents", "doc_entry")
    receivables = w.model("fact_accounts_receivable", "doc_entry", "total_amount", "paid_amount", "open_balance")
    assert receivables.join(invoices, "doc_entry", "left_anti").count() == 0
    assert receivables.where("total_amount - paid_amount <> open_balance").count() == 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_watermark_reaches_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["scan_projected_filtered"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(o_totalprice), IsNotNull(o_orderstatus), GreaterThan(o_totalprice,250000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in plan


def test_sales_lines_are_shuffled_once_for_the_header_join(spark, sf_dir):
    """Without any broadcast: lines cross the network once per document type."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(warehouse(spark, sf_dir).model("fact_sales", "document_type", "doc_entry", "line_total"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("lineitem.parquet") == 2  # invoices and returns, one scan each
    assert "Exchange hashpartitioning(l_orderkey" not in plan  # the raw tables read the lines as they are
    # per type: lines, header dedup, headers after the partner join and again for this join, so a hot document may be split
    assert plan.count("Exchange hashpartitioning(doc_entry") == 8


def test_lean_models_read_fewer_tables(w):
    lean = plan_of(w.model("sales_invoice_documents", "doc_entry", "document_total"))
    assert "customer.parquet" not in lean and "supplier.parquet" not in lean
    assert DRIVER_PARAMS.as_of.year == 2001


@pytest.mark.parametrize("name", ["sales_invoice_lines", "sales_return_lines", "purchases_invoice_lines", "sales_delivery_lines"])
def test_lines_are_shaped_behind_their_last_shuffle(spark, sf_dir, name):
    """Usage and item labels join the driver's lines; a column made of them is in no shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(warehouse(spark, sf_dir).model(name))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert shuffles and "as decimal(20,6)" in plan.split("Exchange hashpartitioning(", 1)[0]
    assert plan.count("l_quantity#") and plan.split("Exchange hashpartitioning(", 1)[1].count("as decimal(20,6)") == 0
    assert plan.count("Exchange hashpartitioning(l_orderkey") == (name != "sales_delivery_lines")


@pytest.mark.parametrize("name", ["sales_fiscal_lines", "purchases_fiscal_lines", "sales_delivery_lines"])
def test_labels_on_the_drivers_lines_equal_labels_on_the_raw_table(spark, sf_dir, name, tmp_path):
    """Also for lines without a master, a usage or a key, and for documents with two usages."""
    driver = DriverTables(spark, sf_dir)
    small = {"lineitem": "l_orderkey <= 60", "orders": "o_orderkey <= 40", "part": "p_partkey % 3 > 0"}
    for table in ("region", "nation", "customer", "supplier", "events", *small):
        kept = driver.table(table).where(small.get(table, "true"))
        if table == "orders":  # a document that has its usage row twice repeats its lines
            kept = kept.unionByName(kept.where("o_orderkey % 10 = 4"))
        if table == "lineitem":
            no_item = kept.where("l_orderkey = 1").withColumn("l_partkey", F.lit(None).cast("bigint"))
            kept = kept.unionByName(no_item)
        kept.write.parquet(str(tmp_path / f"{table}.parquet"))
    odd = DriverTables(spark, str(tmp_path))
    plain = Warehouse(odd.raw, DRIVER_PARAMS).model(name)
    labelled = Warehouse(odd.raw, DRIVER_PARAMS, odd.labelled).model(name)
    assert plain.dtypes == labelled.dtypes and "l_orderkey#" in plan_of(labelled)
    expected = rows(plain)
    assert len(expected) > 100 and rows(labelled) == expected
    assert any(r["item_code"] is None for r in labelled.collect()) and any(r["item_name"] is None for r in labelled.collect())
    assert rows(labelled.select("doc_entry", "line_number")) == rows(plain.select("doc_entry", "line_number"))


@pytest.mark.parametrize("name", ["fact_sales", "fact_purchases"])
def test_headers_join_the_drivers_lines(spark, sf_dir, name, tmp_path):
    """Lines are shaped behind the header join, with the rows of a join of raw tables; one bit of a hash joins, not 64."""
    driver = DriverTables(spark, sf_dir)
    for table in ("region", "nation", "customer", "supplier", "events", "part", "orders", "lineitem"):
        kept = driver.table(table).where({"lineitem": "l_orderkey <= 600", "orders": "o_orderkey <= 500"}.get(table, "true"))
        if table == "lineitem":  # lines without a document, without an item, and twice
            no_item = kept.where("l_orderkey = 4").withColumn("l_partkey", F.lit(None).cast("bigint"))
            kept = kept.unionByName(kept.where("l_orderkey = 1").withColumn("l_orderkey", F.lit(None).cast("bigint")))
            kept = kept.unionByName(no_item).unionByName(kept.where("l_orderkey = 12"))
        kept.write.parquet(str(tmp_path / f"{table}.parquet"))
    odd = DriverTables(spark, str(tmp_path))
    plain, narrow = Warehouse(odd.raw, DRIVER_PARAMS).model(name), Warehouse(odd.raw, DRIVER_PARAMS, odd.labelled).model(name)
    assert plain.dtypes == narrow.dtypes
    expected = rows(plain)
    assert len(expected) > 20 and rows(narrow) == expected
    given = Warehouse(odd.raw, DRIVER_PARAMS, odd.labelled)
    for lines in ("sales_invoice_lines", "sales_return_lines", "purchases_invoice_lines"):
        given.use(lines, given.model(lines))
    assert rows(given.model(name)) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(warehouse(spark, sf_dir).model(name))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "l_extendedprice#" in plan.split("Exchange hashpartitioning(", 1)[0]
    assert "& 1) AS _split" in plan


def test_daily_rows_shuffle_no_derived_quantity(w):
    """The quantity after the last movement follows from its price and value, behind the last shuffle."""
    plan = plan_of(w.model("fact_daily_inventory_movement"))
    assert "max_by(calculated_average_price" in plan and "max_by(quantity_after_movement" not in plan


def test_outflow_joins_bare_stock(spark, sf_dir):
    """Labels of items and places are behind the join by item and warehouse; only covered days are summed."""
    from ledgerflow.plans.marts import with_outflow

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(warehouse(spark, sf_dir).model("fact_inventory"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    outermost = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    by_place = next(i for i, line in enumerate(outermost) if "(item_code" in line and "warehouse_code" in line.split("),")[0])
    assert by_place > 0  # labels are joined by item above the join by item and warehouse
    assert plan.split("Exchange hashpartitioning(item_code", 1)[1].count("GreaterThanOrEqual(l_shipdate") + plan.count(">= 2001-01-01") >= 1
    day = dt.date
    moved = spark.createDataFrame([("a", day(2001, 5, 30), 2.0), ("a", day(2001, 1, 1), 3.0), ("a", day(2000, 12, 31), 5.0), ("a", day(2001, 6, 1), 7.0), ("b", day(1999, 1, 1), 9.0), ("c", day(2001, 5, 1), -1.0)], "k string, movement_date date, outflow_quantity double")
    got = with_outflow(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string"), moved, ["k"], day(2001, 6, 1)).orderBy("k").collect()
    assert [tuple(r) for r in got] == [
        ("a", 2.0, 2.0, 2.0, 5.0, day(2001, 5, 30)), ("b", None, None, None, None, day(1999, 1, 1)),
        ("c", 0.0, -1.0, -1.0, -1.0, None), ("d", None, None, None, None, None),
    ]


def test_raw_lines_are_all_lines(spark, sf_dir):
    """Every line of the driver is a line of one sales document type, under a key of its own."""
    tables = DriverTables(spark, sf_dir)
    lines = tables.table("lineitem").count()
    kinds = [tables.raw(name).select("DocEntry", "LineNum") for name in ("inv1", "qut1", "rin1", "rdr1")]
    assert sum(k.count() for k in kinds) == sum(k.distinct().count() for k in kinds)
    movements = tables.raw("oinm").select("TransNum")
    assert movements.count() == movements.distinct().count() == lines
