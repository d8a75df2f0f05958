"""Edge cases of the cleaning expressions, one hand-made frame per rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import codes, dates, measures, predicates, text
from ledgerflow.operators.joins import match_key


def one(spark, schema, values, *columns):
    """Results of the expressions over hand-made rows, in input order."""
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"_i int, {schema}")
    out = df.select("_i", *(c.alias(f"c{n}") for n, c in enumerate(columns))).orderBy("_i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r["c0"] for r in out]


def col(name="x"):
    return F.col(name)


def test_ptbr_decimal(spark):
    got = one(spark, "x string", [("1.058,50",), ("1058,50",), ("1058.50",), ("abc",), (None,)], text.ptbr_decimal(col()))
    assert got == [Decimal("1058.50")] * 3 + [None, None]


def test_digits_only_and_postal(spark):
    assert one(spark, "x string", [("12.345-678",), ("(21) 9/8,7",), ("AB1",)], text.digits_only(col())) == [
        "12345678", "21987", "AB1",
    ]
    assert one(spark, "x string", [("1234567",), ("123456789",), (None,)], text.zero_pad_postal(col())) == [
        "01234567", "23456789", None,
    ]


def test_clean_notes_keeps_line_feeds_and_right_blanks(spark):
    assert one(spark, "x string", [("\t  a\r\nb ",)], text.clean_notes(col())) == ["a \nb "]


def test_name_segments(spark):
    names = [("Ana - Loja X - Vend - Sr",), ("Ana - Loja X",), ("Ana",), (None,)]
    parts = (text.normalized_name(col()), text.name_segment(col(), 2), text.name_segment(col(), 3))
    assert one(spark, "x string", names, *parts) == [
        ("ana", "Loja X", "Vend - Sr"), ("ana", "Loja X", None), ("ana", None, None), (None, None, None),
    ]


def test_retired_prefix(spark):
    names = [("NÃO UTILIZAR - João Silva - Mega - Vend",), ("nao utilizar - Zé",), ("Ana  - Loja",)]
    assert one(spark, "x string", names, text.canonical_name(col()), text.active_status(col())) == [
        ("joão silva", "inactive"), ("zé", "inactive"), ("ana ", "active"),
    ]


def test_match_key_ignores_case_accents_and_trailing_blanks(spark):
    pairs = [("joão ", "JOAO"), ("ÇÉŠ", "ces"), ("ana", "anna")]
    assert one(spark, "x string, y string", pairs, match_key(col()) == match_key(col("y"))) == [True, True, False]


def test_tax_id(spark):
    values = [("123.456.789-01", "C1"), ("12.345.678/0001-99", "C2"), ("", "C9"), ("  ", "C8"), (None, "C7"), ("123", "C3")]
    tax_id = text.tax_id_normalized(col(), col("y"))
    assert one(spark, "x string, y string", values, tax_id, text.tax_id_bucket(tax_id)) == [
        ("12345678901", "cpf"), ("12345678000199", "cnpj"), ("SAPC9", "no document"), ("SAPC8", "no document"),
        ("SAPC7", "no document"), ("123", "irregular"),
    ]


def test_lenient_int_and_line_key(spark):
    assert one(spark, "x string", [("",), (" 12 ",), ("abc",), (None,)], text.lenient_int(col())) == [0, 12, None, None]
    assert one(spark, "x int, y int", [(7, 2), (7, None), (None, 2)], text.line_key(col(), col("y"))) == ["7/2", "7/", "/2"]


def test_translate_code_keeps_null_labels_and_lowercases_unknown(spark):
    got = one(
        spark, "x string", [("N",), ("P",), ("Zz",), (None,)],
        codes.translate_code(col(), codes.LOAD_KIT), codes.translate_code(col(), codes.LOAD_KIT_QUOTE),
    )
    assert got == [("retail", "retail"), ("unclassified", None), ("zz", "zz"), (None, None)]


def test_movement_slug_and_direction(spark):
    assert one(spark, "x int", [(13,), (10000071,), (999,)], codes.movement_type_slug(col())) == [
        "sales_invoice", "inventory_count", "type_999",
    ]
    assert one(spark, "x int, y int", [(5, 0), (0, 5), (0, 0), (5, 5)], measures.movement_direction(col(), col("y"))) == [
        "inflow", "outflow", "value_adjustment", "mixed",
    ]


@pytest.mark.parametrize(
    ("kind", "canceled", "sign"),
    [("invoice", "no", 1), ("invoice", "canceled", 1), ("invoice", "reversal", -1), ("return", "no", -1),
     ("return", "canceled", -1), ("return", "reversal", 1)],
)
def test_sales_sign(spark, kind, canceled, sign):
    assert one(spark, "x string, y string", [(kind, canceled)], measures.sales_sign(col(), col("y"))) == [sign]


def test_payment_status_and_guarded_ratio(spark):
    pairs = [(0, 0), (10, 10), (3, 10), (0, 10)]
    assert one(spark, "x int, y int", pairs, measures.payment_status(col(), col("y"))) == ["paid", "paid", "partial", "open"]
    assert one(spark, "x int, y int", [(1, 4), (1, 0), (1, -2)], measures.guarded_ratio(col(), col("y"))) == [
        Decimal("0.250000"), None, None,
    ]


def test_visibility_filters(spark):
    cases = [("yes", 111, 9), ("yes", 111, 1), ("yes", None, 1), ("yes", None, 9), ("no", 5, 9)]
    shown, group, branch = F.col("x"), F.col("y"), F.col("z")
    assert one(
        spark, "x string, y int, z int", cases,
        predicates.sales_visible(shown, group, branch), predicates.purchases_visible(F.lit("no"), shown, group),
    ) == [(True, False), (False, False), (None, None), (True, None), (False, False)]


def test_force_display_overrides_every_filter(spark):
    normal = F.col("y")
    got = one(
        spark, "x string, y boolean", [("yes", False), (None, True), ("no", False), ("no", None), (None, None)],
        predicates.force_display(F.col("x"), normal),
    )
    assert got == [True, True, False, None, None]


def test_week_rules(spark):
    days = [(dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),), (dt.date(2023, 1, 7),), (dt.date(2023, 1, 8),), (dt.date(2024, 12, 31),)]
    got = one(spark, "x date", days, dates.week_of_year_us(col()), dates.week_start(col()), dates.week_end(col()))
    assert [g[0] for g in got] == [1, 1, 1, 2, 53]
    assert [g[1] for g in got[:3]] == [dt.date(2023, 1, 2)] * 3
    assert [g[2] for g in got[:3]] == [dt.date(2023, 1, 8)] * 3


def test_boundary_differences_and_integer_timestamps(spark):
    got = one(
        spark, "x timestamp_ntz, y timestamp_ntz",
        [(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0))],
        dates.minutes_between(col(), col("y")), dates.seconds_between(col(), col("y")),
        dates.timestamp_of_ints(F.lit(20240229), F.lit(70503)),
    )
    assert got == [(1, 1, dt.datetime(2024, 2, 29, 7, 5, 3))]
