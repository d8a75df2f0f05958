"""Declared tests of the models and their compilation into one pass per model.

A declaration lists a model's key, its required columns, accepted values, lower
bounds and the masters its codes are found in. `compiled` turns all of them into
one aggregation over the model: a row counts for its key once, for each of its
codes once, and a row that fails row tests once more, with a bit per test, so keys
that repeat and codes without a master come out of the same grouping as the row tests.
Where a model's rows already lie by their key, they are counted by it in place, and
what goes on to that grouping is their codes and what fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgerflow.operators.setops import union_bricks
from ledgerflow.plans.warehouse import Warehouse
from ledgerflow.session import shuffles_freed

_SEPARATOR, _NO_VALUE = "\x1f", "\x1e"


@dataclass(frozen=True)
class Declared:
    """The tests of one model. `key` is unique; a single key column may be NULL, one of several is a value like others."""

    key: Sequence[str]
    required: Sequence[str] = ()
    one_of: Mapping[str, Sequence] = field(default_factory=dict)
    #: code -> (master, its column); a NULL code passes
    found_in: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    at_least: Mapping[str, object] = field(default_factory=dict)
    #: codes whose empty text passes, too
    blank_passes: Sequence[str] = ()
    #: columns whose tests only warn
    warn: Sequence[str] = ()
    #: the model's last grouping or join is by columns of its key, so that counting by the key moves no row; all codes are of the key
    by_key: bool = False

    def tests(self, model: str) -> Iterator[tuple[str, str, str]]:
        """(test, severity, column) of every declared test; the column of the key test is empty."""
        yield f"unique:{model}.{'+'.join(self.key)}", "error", ""
        for kind, columns in (("not_null", self.required), ("accepted_values", self.one_of), ("accepted_range", self.at_least), ("relationships", self.found_in)):
            for column in columns:
                yield f"{kind}:{model}.{column}", "warn" if column in self.warn else "error", column

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.required, *self.one_of, *self.at_least, *self.found_in]))


_DAY = ("dim_date", "date")
_ITEM, _PARTNER = ("dim_item", "item_code"), ("dim_partner", "partner_code")
_STORE, _WAREHOUSE = ("dim_store", "store_code"), ("dim_warehouse", "warehouse_code")
_PERSON = ("dim_employees", "employee_code")
_FLAG = ("yes", "no")

# fixed values: declared tests of the marts
CATALOGUE: dict[str, Declared] = {
    "dim_date": Declared(
        key=["date"],
        required=["date", "quarter", "month", "day_of_week", "weekend"],
        one_of={"quarter": range(1, 5), "month": range(1, 13), "day_of_week": range(1, 8), "weekend": _FLAG},
    ),
    "dim_item": Declared(
        key=["item_code"],
        required=[
            "item_code", "item_name", "is_stockable", "is_sellable", "is_purchased", "is_made_to_order",
            "valid_for_use", "blocked", "item_type", "code_prefix", "category_code",
        ],
        one_of={
            **dict.fromkeys(["is_stockable", "is_sellable", "is_purchased", "is_made_to_order", "valid_for_use", "blocked"], _FLAG),
            "item_type": ("product", "service", "administrative purchase", "others"),
            "category_code": ("administrative expense", "service", "product"),
        },
        warn=["item_name"],
    ),
    "dim_employees": Declared(
        key=["employee_code"],
        required=["employee_code", "employee_name", "sap_full_name", "status"],
        one_of={"status": ("active", "inactive")},
        at_least={"hire_date": dt.date(2025, 1, 1)},
    ),
    "dim_partner": Declared(
        key=["partner_code"],
        required=["partner_code", "partner_type", "cpf_cnpj_normalized", "cpf_cnpj_type"],
        one_of={"partner_type": ("customer", "supplier", "lead"), "cpf_cnpj_type": ("cpf", "cnpj", "no document", "irregular")},
    ),
    "dim_store": Declared(key=["store_code"], required=["store_code", "store_name"]),
    "dim_warehouse": Declared(key=["warehouse_code"], required=["warehouse_code", "warehouse_name"]),
    "fact_sales": Declared(
        key=["document_type", "doc_entry", "line_number"],
        required=[
            "document_id", "document_type", "doc_entry", "line_number", "date", "item_code", "partner_code",
            "employee_code", "canceled", "quantity", "line_total",
        ],
        one_of={"document_type": ("invoice", "return"), "canceled": ("no", "canceled", "reversal")},
        found_in={
            "date": _DAY, "item_code": _ITEM, "partner_code": _PARTNER, "employee_code": _PERSON,
            "store_code": _STORE, "warehouse_code": _WAREHOUSE,
        },
        warn=["employee_code"],
    ),
    "fact_goals": Declared(
        key=["channel", "date", "employee_code", "original_goal_store"],
        required=["channel", "date", "employee_code", "original_goal_store", "daily_goal"],
        one_of={"channel": ("wholesale", "retail"), "bridge_source": ("sap_oslp",)},
        found_in={"date": _DAY, "employee_code": _PERSON, "goal_store_code": _STORE},
    ),
    "fact_purchases": Declared(
        key=["document_type", "doc_entry", "line_number"],
        required=[
            "document_id", "document_type", "doc_entry", "line_number", "issue_date", "item_code", "partner_code",
            "usage_id", "quantity", "line_total",
        ],
        one_of={"document_type": ("invoice",), "usage_id": (3,)},
        found_in={
            "issue_date": _DAY, "accrual_date": _DAY, "due_date": _DAY, "item_code": _ITEM, "partner_code": _PARTNER,
            "store_code": _STORE, "warehouse_code": _WAREHOUSE,
        },
        blank_passes=["store_code"],
    ),
    "fact_accounts_receivable": Declared(
        key=["document_type", "doc_entry"],
        required=[
            "document_type", "doc_entry", "date", "partner_code", "total_amount", "paid_amount", "open_balance",
            "installment_count", "payment_status",
        ],
        one_of={"document_type": ("invoice",), "payment_status": ("paid", "partial", "open")},
        found_in={
            "date": _DAY, "first_due_date": _DAY, "last_due_date": _DAY, "partner_code": _PARTNER,
            "employee_code": _PERSON, "store_code": _STORE,
        },
        blank_passes=["store_code"],
    ),
    "fact_inventory": Declared(
        key=["item_code", "warehouse_code"],
        required=[
            "item_code", "warehouse_code", "inventory_quantity", "committed_quantity", "ordered_quantity",
            "outflow_quantity_30d", "outflow_quantity_45d", "outflow_quantity_60d", "outflow_quantity_ytd",
        ],
        found_in={"item_code": ("item", "item_code"), "warehouse_code": ("warehouse", "warehouse_code")},
        by_key=True,
    ),
    "fact_daily_inventory_movement": Declared(
        key=["date", "item_code", "warehouse_code"],
        required=[
            "date", "item_code", "warehouse_code", "inflow_quantity", "outflow_quantity", "movement_quantity",
            "transacted_amount", "movement_count",
        ],
        found_in={"item_code": ("item", "item_code"), "warehouse_code": ("warehouse", "warehouse_code")},
        by_key=True,
    ),
}


def _failing(declared: Declared, test: str, column: str) -> Column:
    """Whether a row fails a row test; a value that is NULL fails only the first kind."""
    value, kind = F.col(f"`{column}`"), test.partition(":")[0]
    if kind == "not_null":
        return value.isNull()
    if kind == "accepted_values":
        return ~value.isin(*declared.one_of[column])
    return value < F.lit(declared.at_least[column])


def _key(columns: Sequence[str]) -> Column:
    return F.concat_ws(_SEPARATOR, *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(_NO_VALUE)) for c in columns))


def _entry(no: Column, value: Column, n: Column) -> Column:
    return F.struct(no.cast("bigint").alias("no"), value.alias("value"), n.cast("bigint").alias("n"))


def _entries_by_row(rows: DataFrame, declared: Declared, row_tests: Mapping[int, Column], codes: Sequence[Column]) -> DataFrame:
    """no, value: a row under its key, under each of its codes and, with the marks of the tests it fails, under its key."""
    marks = F.lit(0).cast("bigint")
    for i, fails in row_tests.items():
        marks = marks.bitwiseOR(F.when(fails, F.lit(1 << i)).otherwise(0).cast("bigint"))
    narrow = rows.select(_key(declared.key).alias("_key"), marks.alias("_marks"), *(c.alias(f"_code{n}") for n, c in enumerate(codes)))
    entries = [F.struct(F.lit(0).cast("bigint").alias("no"), F.col("_key").alias("value"))]
    entries += [F.struct(F.lit(n + 1).cast("bigint").alias("no"), F.col(f"_code{n}").alias("value")) for n in range(len(codes))]
    if row_tests:
        entries.append(F.struct((-F.col("_marks")).alias("no"), F.when(F.col("_marks") != 0, F.col("_key")).alias("value")))
    return narrow.select(F.inline(F.array(*entries))).where("value IS NOT NULL")


def _entries_by_key(rows: DataFrame, declared: Declared, row_tests: Mapping[int, Column], codes: Sequence[Column]) -> DataFrame:
    """The same, with their number n, of rows counted by their key: only a key that repeats has an entry, and one per test that rows of it fail."""
    keys = [F.col(f"`{c}`") for c in declared.key]
    failing = [F.count(F.when(fails, 1)).alias(f"_fails{i}") for i, fails in row_tests.items()]
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *failing)
    key, times = _key(declared.key), F.col("_n")
    told = [_entry(F.lit(0), F.when(times > 1, key), times)]
    told += [_entry(F.lit(-(1 << i)), F.when(F.col(f"_fails{i}") > 0, key), F.col(f"_fails{i}")) for i in row_tests]
    listed = [_entry(F.lit(n + 1), c, times) for n, c in enumerate(codes)]
    sound = times == 1
    for i in row_tests:
        sound = sound & (F.col(f"_fails{i}") == 0)
    entries = F.when(sound, F.array(*listed)).otherwise(F.array(*told, *listed))
    return counted.select(F.inline(entries)).where("value IS NOT NULL")


def compiled(model: str, rows: DataFrame, declared: Declared, masters: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared test of a model: test, severity, failures, sample (a failing key or code).

    `masters` holds the masters that codes are looked up in, by name.
    """
    tests = list(declared.tests(model))
    codes = list(declared.found_in)
    # the row tests by their place in the list, which is the bit that a row failing them carries
    row_tests = {i: _failing(declared, test, c) for i, (test, _, c) in enumerate(tests) if c and not test.startswith("relationships")}
    if len(tests) > 62:
        raise ValueError(f"{model}: {len(tests)} tests, a row's marks hold 62")
    if declared.by_key and not set(codes) <= set(declared.key):
        raise ValueError(f"{model}: only codes of the key are there once rows are counted by it")

    def code(column: str) -> Column:
        text = F.col(f"`{column}`").cast("string")
        return F.nullif(text, F.lit("")) if column in declared.blank_passes else text

    # number 0 is the row under its key, a positive one a code, a negative one the marks of a row that fails, under its key
    if declared.by_key:
        flat, n = _entries_by_key(rows, declared, row_tests, [code(c) for c in codes]), F.sum("n")
    else:
        flat, n = _entries_by_row(rows, declared, row_tests, [code(c) for c in codes]), F.count(F.lit(1))
    # a key that occurs once has nothing to tell, and it goes before anything is sorted
    grouped = flat.groupBy("no", "value").agg(n.alias("n")).where("no <> 0 OR n > 1")

    known = []
    for master in dict.fromkeys(m for m, _ in declared.found_in.values()):
        mine = [(n + 1, declared.found_in[c][1]) for n, c in enumerate(codes) if declared.found_in[c][0] == master]
        listed = F.explode(F.array(*(F.struct(F.lit(n).cast("bigint").alias("no"), F.col(theirs).cast("string").alias("value")) for n, theirs in mine)))
        known.append(masters[master].select(listed.alias("e")).select("e.no", "e.value"))
    if known:
        masters_of = union_bricks(known).where("value IS NOT NULL").distinct().withColumn("known", F.lit(True))
        grouped = grouped.join(masters_of, ["no", "value"], "left")
    else:
        grouped = grouped.withColumn("known", F.lit(True))
    grouped = grouped.where("no <= 0 OR known IS NULL")

    results = []
    single_null = F.col("value") == _NO_VALUE if len(declared.key) == 1 else F.lit(False)
    for i, (test, severity, column) in enumerate(tests):
        if not column:
            fails = (F.col("no") == 0) & (F.col("n") > 1) & ~single_null
            failures, sample = F.count(F.when(fails, 1)), F.min(F.when(fails, F.col("value")))
        elif column in codes and test.startswith("relationships"):
            fails = (F.col("no") == codes.index(column) + 1) & F.col("known").isNull()
            failures, sample = F.sum(F.when(fails, F.col("n")).otherwise(0)), F.min(F.when(fails, F.col("value")))
        else:
            fails = (F.col("no") < 0) & ((-F.col("no")).bitwiseAND(F.lit(1 << i)) != 0)
            failures, sample = F.sum(F.when(fails, F.col("n"))), F.min(F.when(fails, F.col("value")))
        shown = F.translate(sample, _SEPARATOR + _NO_VALUE, "/")
        results.append(F.struct(F.lit(test).alias("test"), F.lit(severity).alias("severity"), F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"), shown.alias("sample")))
    return grouped.agg(F.array(*results).alias("tests")).select(F.inline("tests"))


def catalogue_results(w: Warehouse, models: Sequence[str] | None = None) -> DataFrame:
    """test, severity, failures, sample of every declared test; each model is read once, and each master once per model."""

    def results(model: str) -> DataFrame:
        declared = CATALOGUE[model]
        masters = {m: w.model(m, c) for m, c in declared.found_in.values()}
        return compiled(model, w.model(model, *declared.columns()), declared, masters)

    return union_bricks(results(m) for m in models or CATALOGUE)


def tested_in_turn(w: Warehouse, models: Sequence[str] | None = None) -> DataFrame:
    """The rows of `catalogue_results`, one model's tests run after another's.

    The disk holds the shuffles of one model at a time instead of those of all. What
    comes to the driver is a row per declared test.
    """
    spark = w.raw("oinv").sparkSession
    rows: list[Row] = []
    with shuffles_freed(spark):
        for name in models or CATALOGUE:
            counts = catalogue_results(w, [name])
            rows += counts.collect()
    return spark.createDataFrame(rows, counts.schema)
