"""Registration of a Spark query together with its check SQL."""

from __future__ import annotations

import dataclasses
import datetime as dt
import re
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerflow.contract import COLUMNS, column_type
from ledgerflow.plans.models import Params, Warehouse
from ledgerflow.sources.driver import DriverTables
from ledgerflow.sources.raw_sql import RAW_SQL, check_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

# the driver's tables span 1995-2001: run dates are shifted into that range
DRIVER_PARAMS = Params(
    as_of=dt.date(2001, 6, 1),
    run_date=dt.date(2001, 6, 1),
    goal_min_year=1996,
    goal_mart_min_year=1997,
    bridge_floor=dt.date(1997, 1, 1),
    bridge_default=dt.date(1997, 10, 1),
)
# the declared tests look days up in a calendar over the driver's dates
TEST_PARAMS = dataclasses.replace(DRIVER_PARAMS, calendar_start=dt.date(1995, 1, 1), calendar_end=dt.date(2001, 12, 31))


def warehouse(spark: SparkSession, sf_dir: str, params: Params = DRIVER_PARAMS) -> Warehouse:
    tables = DriverTables(spark, sf_dir)
    return Warehouse(tables.raw, params, tables.labelled)


def published(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as double, days and times as ISO text.

    Column order and names stay; only the outermost projection changes, so a
    comparison with another engine does not depend on type representations.
    """
    out = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 0 and field.dataType.precision > 18:
            name = f"CAST({name} AS STRING) AS {name}"  # long numbers, which a double would round
        elif isinstance(field.dataType, T.DecimalType):
            name = f"CAST({name} AS DOUBLE) AS {name}"
        elif isinstance(field.dataType, T.DateType):
            name = f"CAST({name} AS STRING) AS {name}"
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            name = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss') AS {name}"
        out.append(name)
    return df.selectExpr(*out)


class Tables:
    """What a registered query may read: driver tables and the warehouse over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._tables = DriverTables(spark, sf_dir)
        self.w = Warehouse(self._tables.raw, DRIVER_PARAMS, self._tables.labelled)
        self.tested = Warehouse(self._tables.raw, TEST_PARAMS, self._tables.labelled)

    def __getattr__(self, name: str) -> DataFrame:
        return self._tables.table(name)


def query(key: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    """Register `fn(tables) -> DataFrame` under a key, with its check SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        QUERIES[key] = lambda spark, sf_dir: published(fn(Tables(spark, sf_dir)))
        if sql is not None:
            CHECKS[key] = with_dependencies(textwrap.dedent(sql).strip())
        return fn

    return register


# check SQL of the models, by name; filled by model_sql
MODEL_SQL: dict[str, str] = {}
_NAMED = re.compile(r"\b(raw|m)_(\w+)\b")


def with_dependencies(sql: str) -> str:
    """Prefix the CTEs of every raw_x and m_x the text mentions, in order."""
    ordered: dict[str, str] = {}

    def visit(text: str) -> None:
        for kind, name in _NAMED.findall(text):
            cte = f"{kind}_{name}"
            known = RAW_SQL if kind == "raw" else MODEL_SQL
            if cte in ordered or name not in known:
                continue
            body = check_sql(name) if kind == "raw" else MODEL_SQL[name]
            visit(body)
            ordered[cte] = body
    visit(sql)
    if not ordered:
        return sql
    ctes = ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ordered.items())
    if sql.upper().startswith("WITH "):
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"


def check_column(column: str, kind: str) -> str:
    """Check-side counterpart of `published` for one typed column."""
    if kind == "decimal(38,0)":
        return f"CAST(CAST({column} AS {kind}) AS VARCHAR) AS {column}"
    if kind.startswith("decimal"):
        return f"CAST(CAST({column} AS {kind}) AS DOUBLE) AS {column}"
    if kind == "date":
        return f"CAST(CAST({column} AS DATE) AS VARCHAR) AS {column}"
    if kind == "timestamp_ntz":
        return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"
    sql_type = {"string": "VARCHAR", "int": "INTEGER"}.get(kind, kind)
    return f"CAST({column} AS {sql_type}) AS {column}"


def model_check(name: str) -> str:
    columns = ",\n    ".join(check_column(c, column_type(name, c)) for c in COLUMNS[name])
    return f"SELECT\n    {columns}\nFROM m_{name}"


def register_model(key: str, name: str) -> None:
    query(key, model_check(name))(lambda t: t.w.model(name))
