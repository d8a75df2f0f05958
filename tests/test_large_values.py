"""Keys and amounts far beyond those of the driver's tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as N

import duckdb
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.functions.measures import guarded_ratio, product, total
from ledgerflow.sources.raw_sql import RAW_SQL, check_sql

LINES = [
    # order, part, supplier, line, day
    (5_000_000_000_123, 300_000_007, 4_000_001, 1, dt.datetime(2001, 12, 31)),
    (5_000_000_000_123, 300_000_007, 4_000_001, 2, dt.datetime(2001, 12, 31)),
    (5_000_000_000_123, 300_000_007, 4_000_002, 1, dt.datetime(2001, 12, 31)),
    (5_000_000_000_123, 300_000_008, 4_000_001, 1, dt.datetime(1995, 1, 1)),
    (5_000_000_000_124, 1, 1, 1, dt.datetime(1995, 1, 1)),
    (922_338, 99_999, 1_000, 7, dt.datetime(1998, 6, 1)),
]
COLUMNS = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz"
OTHERS = {"l_quantity": "1.0D", "l_extendedprice": "10.0D", "l_discount": "0.0D", "l_tax": "0.0D", "l_returnflag": "'N'", "l_linestatus": "'F'"}


def test_movement_and_line_numbers_have_no_small_limit(spark):
    """Orders over 10^12, parts over 10^8 and suppliers over 10^6 give distinct numbers in the order of the keys, in both engines."""
    frame = spark.createDataFrame(LINES, COLUMNS).selectExpr("*", *(f"{v} AS {k}" for k, v in OTHERS.items()))
    frame.createOrReplaceTempView("large_lines")
    sql = RAW_SQL["oinm"].format(lineitem="large_lines")
    got = spark.sql(sql).select("TransNum", "DocLineNum", "CreatedBy").collect()
    numbers = [r["TransNum"] for r in got]
    assert len(set(numbers)) == len(LINES) and all(n > 0 for n in numbers)
    ordered = [r["CreatedBy"] for r in sorted(got, key=lambda r: r["TransNum"])]
    assert ordered == sorted(ordered)
    con = duckdb.connect()
    con.execute("CREATE TABLE lineitem (l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_shipdate TIMESTAMP, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag VARCHAR, l_linestatus VARCHAR)")
    con.executemany("INSERT INTO lineitem VALUES (?, ?, ?, ?, ?, 1, 10, 0, 0, 'N', 'F')", LINES)
    theirs = con.execute(f"SELECT TransNum, DocLineNum, CreatedBy FROM ({check_sql('oinm')})").fetchall()
    assert sorted(theirs) == sorted(map(tuple, got))


def test_amounts_over_ten_to_the_twelve(spark):
    pairs = [(N("2500000000000.000001"), N("3")), (N("1.000001"), N("999999.999999")), (N("-5000000000000"), N("2")), (None, N("1"))]
    df = spark.createDataFrame(pairs, "a decimal(20,6), b decimal(20,6)")
    got = [r[0] for r in df.select(product(F.col("a"), F.col("b"))).collect()]
    assert (got[0], got[2], got[3]) == (N("7500000000000.000003"), N("-10000000000000.000000"), None)
    assert abs(got[1] - N("1.000001") * N("999999.999999")) <= N("0.0000005")


def test_totals_over_ten_to_the_fourteen(spark):
    df = spark.range(50).select(F.lit("9000000000000").cast("decimal(20,6)").alias("v"), F.lit("3").cast("decimal(20,6)").alias("w"))
    sums = df.agg(total(F.sum("v")).alias("v"), total(F.sum("w")).alias("w"))
    assert rows(sums) == [(N("450000000000000.000000"), N("150.000000"))]
    assert rows(sums.select(guarded_ratio(F.col("v"), F.col("w")))) == [(N("3000000000000.000000"),)]
    small = spark.createDataFrame([(N("1"), N("3")), (N("2"), N("0")), (N("2"), N("-1"))], "a decimal(20,6), b decimal(20,6)")
    assert [r[0] for r in small.select(guarded_ratio(F.col("a"), F.col("b"))).collect()] == [N("0.333333"), None, None]
