"""Joins, dedup, SCD2 and quality operators on small frames and against brute force."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerflow.operators import quality
from ledgerflow.operators.joins import code_or_name, lookup, overlapping_periods, temporal_left_join
from ledgerflow.operators.latest import first_per_key, latest_per_key
from ledgerflow.operators.scd2 import scd2_apply
from ledgerflow.operators.as_of import as_of_join, overlap_offenders
from ledgerflow.operators.skew import anti_join, join_lines_to_headers, semi_join

D = dt.date


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, "only"), (None, 3, "a"), (None, 2, "b")], "k int, at int, v string")
    got = latest_per_key(df, ["k"], "at")
    assert plan_of(got).count("WindowGroupLimit") == 2  # one side of the exchange each
    assert rows(got) == sorted([(1, 9, "new"), (2, 1, "only"), (None, 3, "a")], key=repr)


def test_lookup_left_out_when_nothing_is_needed(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    dimension = spark.range(2).select(F.col("id").alias("k"), F.lit("x").alias("label"))
    assert lookup(df, dimension, {"k": "k"}, {"label": F.col("label")}, need={"other"}) is df
    assert rows(lookup(df, dimension, {"k": "k"}, {"label": F.col("label")})) == [(0, "x"), (1, "x"), (2, None)]


def test_code_or_name_fans_out_when_a_name_is_another_code(spark):
    stores = spark.createDataFrame([("01", "Centro"), ("02", "01")], "code string, name string")
    docs = spark.createDataFrame([("01",), ("Centro",), ("x",)], "entry string")
    got = docs.join(code_or_name(stores, "code", "name"), "entry", "left")
    assert rows(got) == [("01", "01"), ("01", "02"), ("Centro", "01"), ("x", None)]


def test_temporal_join_and_priority(spark):
    goals = spark.createDataFrame(
        [("ana", D(2026, 1, 5), "05"), ("ana", D(2026, 1, 6), "99"), ("zé", D(2024, 1, 1), "02")], "name string, day date, store string"
    )
    versions = spark.createDataFrame(
        [("ANA", D(2025, 1, 1), None, "02", 7), ("Aná ", D(2025, 6, 1), None, "05", 8), ("ze", D(2025, 1, 1), D(2025, 12, 31), "02", 9)],
        "name string, since date, until date, at string, code int",
    )
    joined = temporal_left_join(goals, versions, "name", "day", "since", "until")
    same = F.when(F.col("at") == F.col("store"), 0).otherwise(1)
    best = first_per_key(joined, ["name", "day", "store"], [same, F.col("since").desc()])
    assert rows(best.select("name", "day", "code")) == sorted(
        [("ana", D(2026, 1, 5), 8), ("ana", D(2026, 1, 6), 8), ("zé", D(2024, 1, 1), None)], key=repr
    )


def test_scd2_step(spark):
    schema = "code int, store string, valid_from date, valid_to date"
    start, run = D(2025, 1, 1), D(2026, 1, 10)
    current = spark.createDataFrame(
        [(7, "02", start, None), (8, "03", start, None), (9, "04", start, None), (6, "01", start, D(2025, 5, 1))], schema
    )
    incoming = spark.createDataFrame([(7, "05", None, None), (8, "03", None, None), (10, "06", None, None)], schema)
    # 9 lost its store and 8 kept it; blanks around a store do not count
    master = spark.createDataFrame([(7, " 05 "), (8, "03 "), (9, "  "), (10, "06")], "code int, store string")
    state = scd2_apply(current, incoming, master, "code", "store", run)
    expected = [
        (7, "02", start, D(2026, 1, 9)), (7, "05", run, None), (8, "03", start, None), (9, "04", start, None),
        (6, "01", start, D(2025, 5, 1)), (10, "06", run, None),
    ]
    assert rows(state) == sorted(expected, key=repr)
    again = scd2_apply(state, incoming, master, "code", "store", D(2026, 1, 11))
    assert rows(again) == rows(state)


def test_overlaps_touching_periods(spark):
    schema = "k int, a date, b date"
    bad = spark.createDataFrame([(1, D(2025, 1, 1), D(2025, 1, 10)), (1, D(2025, 1, 10), None)], schema)
    good = spark.createDataFrame([(1, D(2025, 1, 1), D(2025, 1, 9)), (1, D(2025, 1, 10), None)], schema)
    assert overlapping_periods(bad, ["k"], "a", "b").count() == 1
    assert overlapping_periods(good, ["k"], "a", "b").count() == 0


@pytest.mark.parametrize("width", [3, 30, 366])
def test_overlaps_equal_brute_force(spark, width):
    rng = random.Random(7)
    data = []
    for _ in range(300):
        start = D(2024, 1, 1) + dt.timedelta(days=rng.randrange(400))
        end = None if rng.random() < 0.1 else start + dt.timedelta(days=rng.randrange(-2, 60))
        data.append((rng.choice([1, 1, 1, 2, 3]), start, end))
    top = D(9999, 12, 31)
    expected = [
        (k, s, e, s2, e2)
        for k, s, e in data
        for k2, s2, e2 in data
        if k == k2 and s < s2 and s2 <= (e or top) and s <= (e2 or top)
    ]
    frame = spark.createDataFrame(data, "k int, a date, b date")
    for limit in (1000, 2):  # whole buckets, and buckets split down to days
        assert rows(overlapping_periods(frame, ["k"], "a", "b", width, limit)) == sorted(expected, key=repr)


def test_crowded_bucket_is_not_compared_with_itself(spark):
    """20,000 one-day periods of one key in one bucket: few rows meet, and no two overlap but neighbours."""
    crowded = spark.range(20_000).selectExpr("1 AS k", "date_add(DATE '2000-01-01', cast(id % 360 AS int)) AS a", "date_add(DATE '2000-01-01', cast(id % 360 AS int)) AS b", "id")
    assert overlapping_periods(crowded.drop("id"), ["k"], "a", "b", 366, 50).count() == 0
    longer = crowded.where("id < 360").select("k", "a", F.date_add("b", 1).alias("b"))
    assert overlapping_periods(longer, ["k"], "a", "b", 366, 10).count() == 359


def _lines_and_headers(spark):
    """A third of the lines on one document, and a header table deduplicated on its key."""
    lines = spark.range(60_000).selectExpr("if(id % 3 = 0, 0, id) AS doc", "id AS line", "repeat('x', 200) AS note")
    headers = spark.range(50_000).selectExpr("id AS doc", "id % 7 AS kind").groupBy("doc").agg(F.max("kind").alias("kind"))
    return lines, headers


def test_hot_key_join_equals_plain_join(spark):
    lines, headers = _lines_and_headers(spark)
    for how in ("inner", "left"):
        got = join_lines_to_headers(lines, headers, ["doc"], how)
        assert got.exceptAll(lines.join(headers, ["doc"], how)).count() == 0
        assert got.count() == lines.join(headers, ["doc"], how).count()
    with pytest.raises(ValueError):
        join_lines_to_headers(lines, headers, ["doc"], "full")


@pytest.fixture
def small_partitions(spark):
    """Thresholds at which adaptive execution takes a few kilobytes for a hot partition; no broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_split_by_adaptive_execution(spark, small_partitions):
    lines, headers = _lines_and_headers(spark)
    joined = join_lines_to_headers(lines.repartition(8), headers, ["doc"])
    joined.collect()
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("join", [semi_join, anti_join])
def test_membership_splits_a_hot_key_and_its_repeats(spark, small_partitions, join):
    """A third of both sides is one key; the right side sends it once per task."""
    lines, _ = _lines_and_headers(spark)
    known = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id * 3 + 1) AS doc", "id AS other")
    got = join(lines.repartition(8), known, ["doc"])
    assert got.count() == lines.join(known.select("doc").distinct(), "doc", "left_semi" if join is semi_join else "left_anti").count()
    got.collect()
    assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()


def test_membership_nulls_names_and_pairs_of_keys(spark):
    left = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (None, "a", "z"), (2, None, "w"), (1, "a", "x")], "k int, v string, _known0 string")
    right = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (2, None)], "code int, v string")
    assert rows(semi_join(left, right, {"k": "code", "v": "v"})) == [(1, "a", "x"), (1, "a", "x")]
    assert rows(anti_join(left, right, {"k": "code", "v": "v"})) == sorted([(1, "b", "y"), (None, "a", "z"), (2, None, "w")], key=repr)
    assert semi_join(left, right, {"k": "code"}).columns == left.columns
    assert semi_join(left, right.where("false"), {"k": "code"}).count() == 0 and anti_join(left, right.where("false"), {"k": "code"}).count() == 5


def _periods(rng, n, names):
    data = []
    for _ in range(n):
        start = D(2024, 1, 1) + dt.timedelta(days=rng.randrange(900))
        end = None if rng.random() < 0.05 else start + dt.timedelta(days=rng.randrange(-3, 50))
        data.append((rng.choice(names), start, end))
    return data


@pytest.mark.parametrize("width", [1, 40, 4000])
def test_overlap_offenders_equal_brute_force(spark, width):
    data = list(dict.fromkeys(_periods(random.Random(3), 250, [1, 1, 1, 2, 3, None])))
    top, expected = D(9999, 12, 31), []
    for k, s, e in data:
        seen = [(e2 or top, s2, e2) for k2, s2, e2 in data if k2 == k is not None and s2 < s and s <= (e2 or top) and s2 <= (e or top)]
        if seen:
            reach, s2, e2 = max(seen, key=lambda x: x[:2])
            expected.append((k, s2, e2, s, e))
    got = overlap_offenders(spark.createDataFrame(data, "k int, a date, b date"), ["k"], "a", "b", width)
    assert rows(got) == sorted(expected, key=repr)


def test_nested_periods_give_no_pairs(spark):
    """Every one of 2,000 nested periods overlaps all others: one row each, but for the first."""
    nested = spark.range(2000).selectExpr("1 AS k", "date_add(DATE '2020-01-01', cast(id AS int)) AS a", "date_add(DATE '2040-01-01', cast(-id AS int)) AS b")
    got = overlap_offenders(nested, ["k"], "a", "b")
    assert got.count() == 1999 and got.select("start_a").distinct().count() == 1


@pytest.mark.parametrize("width", [7, 366])
def test_as_of_join_equals_range_join(spark, width):
    rng = random.Random(11)
    starts = {n: sorted({rng.randrange(1500) for _ in range(40)}) for n in ("Ana", "Zé", "x")}
    day = lambda n: D(2020, 1, 1) + dt.timedelta(days=n)
    versions = [
        (n.upper() + " ", day(s), None if e is None else day(e - rng.choice([1, 1, 5])), i)
        for n, at in starts.items() for i, (s, e) in enumerate(zip(at, [*at[1:], None], strict=True))
    ]
    facts = [(i, rng.choice(["Ana", "ANA", "Ze", "x", "none", None]), None if i % 50 == 0 else day(rng.randrange(-10, 1600))) for i in range(600)]
    left = spark.createDataFrame(facts, "id int, name string, day date")
    right = spark.createDataFrame(versions, "name string, since date, until date, v int")
    got = as_of_join(left, right, "name", "day", "since", "until", {"v": "v"}, width)
    assert got.columns == ["id", "name", "day", "v"]
    want = temporal_left_join(left, right, "name", "day", "since", "until").select("id", "name", "day", "v")
    assert rows(got) == rows(want) and got.where("v IS NOT NULL").count() > 300


def test_as_of_join_does_not_compare_a_name_with_its_versions(spark):
    """20,000 rows meet 10,000 versions of one name in a number of rows that is their sum."""
    left = spark.range(20_000).selectExpr("'ana' AS name", "date_add(DATE '1990-01-01', cast(id % 12000 AS int)) AS day", "id")
    right = spark.range(10_000).selectExpr("'ANA' AS name", "date_add(DATE '1990-01-01', cast(id AS int)) AS since", "date_add(DATE '1990-01-01', cast(id AS int)) AS until", "id AS v")
    got = as_of_join(left, right, "name", "day", "since", "until", {"v": "v"})
    assert got.count() == 20_000
    assert got.where("day < DATE '1990-01-01' + INTERVAL 10000 DAY AND v = datediff(day, DATE '1990-01-01')").count() == got.where("v IS NOT NULL").count() > 16_000
    got.collect()
    nodes, stack = [], [got._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        if node.metrics().contains("numOutputRows"):
            nodes.append((name, node.metrics().apply("numOutputRows").value()))
        stack.extend(node.children().apply(i) for i in range(node.children().size()))
    assert nodes and max(n for _, n in nodes) <= 2 * (20_000 + 10_000), nodes


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (None, "z", None), (None, "a", 2)], "k int, v string, n int")
    parent = spark.createDataFrame([("a",), ("b",)], "code string")
    assert quality.not_null(df, "k").count() == 2
    assert rows(quality.unique_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.accepted_values(df, "v", ["a", "b"])) == [("z", 1)]
    assert rows(quality.relationships(df, "v", parent, "code").select("v")) == [("z",)]
    assert quality.relationships(df, "v", parent, "code", F.col("k") == 1).count() == 0
    assert rows(quality.accepted_range(df, "n", minimum=0).select("n")) == [(-1,)]
    checks = [
        quality.Check("nulls", quality.not_null(df, "k"), "v", "warn"),
        quality.Check("twice", quality.unique_keys(df, ["k"]), "k"),
        quality.Check("fine", quality.not_null(df, "v"), "k"),
    ]
    results = quality.run_results(checks, dt.datetime(2026, 1, 1)).select("test", "status", "failures", "sample")
    assert rows(results) == [("fine", "pass", 0, None), ("nulls", "warn", 2, "a"), ("twice", "fail", 1, "1")]


def test_declared_tests_in_one_pass(spark):
    from ledgerflow.plans.catalogue import Declared, compiled

    rows_ = [("a", 1, "x", "S1", D(2025, 1, 1)), ("a", 1, "y", "S2", None), ("a", None, "x", "", D(2024, 1, 1)), ("a", None, "z", None, D(2025, 2, 1)), ("b", 2, None, "S9", D(2025, 1, 1)), ("b", 3, "z", "S9", None)]
    df = spark.createDataFrame(rows_, "kind string, n int, v string, store string, day date")
    declared = Declared(key=["kind", "n"], required=["v", "n"], one_of={"v": ("x", "y")}, found_in={"store": ("stores", "code")}, at_least={"day": D(2025, 1, 1)}, blank_passes=["store"], warn=["n"])
    stores = spark.createDataFrame([("S1",), ("S2",), ("S2",), (None,)], "code string")
    got = compiled("t", df, declared, {"stores": stores})
    assert rows(got) == sorted([
        ("unique:t.kind+n", "error", 2, "a/"), ("not_null:t.v", "error", 1, "b/2"), ("not_null:t.n", "warn", 2, "a/"),
        ("accepted_values:t.v", "error", 2, "a/"), ("accepted_range:t.day", "error", 1, "a/"), ("relationships:t.store", "error", 2, "S9"),
    ], key=repr)
    assert rows(compiled("t", df.where("false"), declared, {"stores": stores}).select("failures")) == [(0,)] * 6
    single = Declared(key=["n"])
    assert rows(compiled("t", df, single, {})) == [("unique:t.n", "error", 1, "1")]


def test_declared_tests_carry_no_column_per_test(spark, sf_dir):
    """What is shuffled per key and code is a count, however many tests a model has; keys that occur once are not sorted."""
    from ledgerflow.entries.base import warehouse
    from ledgerflow.plans.catalogue import Declared, catalogue_results, compiled

    plan = plan_of(catalogue_results(warehouse(spark, sf_dir), ["fact_sales"]))
    assert "sum(CASE WHEN" not in plan.split("partial_count(1)")[-1].split("Exchange")[0]
    assert "lambdafunction" not in plan and "n#" in plan
    df = spark.createDataFrame([("a", None, "q"), ("a", None, "q"), ("b", 5, "q"), (None, 1, "x")], "k string, v int, w string")
    got = compiled("t", df, Declared(key=["k"], required=["v", "w"], one_of={"w": ("x",)}, at_least={"v": 3}, warn=["v"]), {})
    assert rows(got) == sorted([
        ("unique:t.k", "error", 1, "a"), ("not_null:t.v", "warn", 2, "a"), ("not_null:t.w", "error", 0, None),
        ("accepted_values:t.w", "error", 3, "a"), ("accepted_range:t.v", "warn", 1, ""),
    ], key=repr)


def test_rows_that_lie_by_their_key_are_counted_in_place(spark, sf_dir):
    """The same results, and no key that is sound goes on to the grouping of entries."""
    from ledgerflow.entries.base import TEST_PARAMS, warehouse
    from ledgerflow.plans import catalogue
    from ledgerflow.plans.catalogue import CATALOGUE, Declared, catalogue_results, compiled

    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 1, None), ("a", None, None), ("a", None, 0), ("b", None, 9), (None, 2, None), ("", 2, 1), ("c", 7, 2)], "k string, n int, v int"
    )
    masters = {"m": spark.createDataFrame([("a",), ("a",), (None,)], "code string")}
    tests = {"required": ["n", "v", "k"], "at_least": {"v": 1}, "one_of": {"n": (1, 2)}}
    for found in ({}, {"found_in": {"k": ("m", "code")}}, {"found_in": {"k": ("m", "code")}, "blank_passes": ["k"]}):
        for key in (["k", "n"], ["k"]):
            by_row, by_key = (Declared(key=key, **tests, **found, by_key=b) for b in (False, True))
            assert rows(compiled("t", df, by_key, masters)) == rows(compiled("t", df, by_row, masters))
            assert rows(compiled("t", df.where("false"), by_key, masters)) == rows(compiled("t", df.where("false"), by_row, masters))
    with pytest.raises(ValueError, match="codes of the key"):
        compiled("t", df, Declared(key=["n"], found_in={"k": ("m", "code")}, by_key=True), masters)
    name = "fact_daily_inventory_movement"
    w, declared = warehouse(spark, sf_dir, TEST_PARAMS), CATALOGUE[name]
    days = w.model(name, *declared.columns())
    entries = catalogue._entries_by_key(days, declared, {}, [F.col("item_code"), F.col("warehouse_code")])
    assert entries.count() == 2 * days.count() and entries.where("no <= 0").count() == 0
    assert plan_of(catalogue_results(w, [name])).count("Exchange hashpartitioning(movement_date") == 1
    assert "Exchange hashpartitioning(date" not in plan_of(catalogue_results(w, [name]))


def test_models_are_tested_in_turn(spark, sf_dir, monkeypatch):
    """A model's shuffle files are gone before the next one is read; the session's setting is as it was."""
    from ledgerflow.entries.registry import QUERIES
    from ledgerflow.entries.base import warehouse
    from ledgerflow.plans import catalogue
    from ledgerflow.session import FREED

    def files() -> set[str]:
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return {f.rpartition("/")[2] for f in found.split(",") if "/shuffle_" in f}

    lazily, left, asked = catalogue.catalogue_results, [], []

    def watched(w, models):
        left.append(len(files() - before))
        asked.extend(models)
        return lazily(w, models)

    small = {m: catalogue.CATALOGUE[m] for m in ("fact_purchases", "fact_goals", "dim_item")}
    w = warehouse(spark, sf_dir)
    expected = lazily(w, list(small))
    held = rows(expected)
    monkeypatch.setattr(catalogue, "CATALOGUE", small)
    monkeypatch.setattr(catalogue, "catalogue_results", watched)
    for had in (None, "false"):
        if had:
            spark.conf.set(FREED, had)
        before = files()
        assert before
        got = QUERIES["dq_catalogue"](spark, sf_dir)
        left.append(len(files() - before))
        assert spark.conf.get(FREED, None) == had and got.columns == expected.columns
        assert rows(catalogue.tested_in_turn(w)) == held and got.count() == len(held)
    spark.conf.unset(FREED)
    assert asked == 4 * list(small) and not any(left)


def test_catalogue_holds_the_contract_columns():
    from ledgerflow.contract import COLUMNS
    from ledgerflow.plans.catalogue import CATALOGUE

    for model, declared in CATALOGUE.items():
        assert set(declared.columns()) <= set(COLUMNS[model]), model
        assert all(column in COLUMNS[master] for master, column in declared.found_in.values()), model
        assert len({test for test, *_ in declared.tests(model)}) == len(list(declared.tests(model)))
    assert sum(len(list(d.tests(m))) for m, d in CATALOGUE.items()) > 130


def test_each_declared_model_is_read_once(spark, sf_dir):
    """The scans of a compiled model are those of the model and its masters."""
    from ledgerflow.entries.base import warehouse
    from ledgerflow.plans.catalogue import CATALOGUE, catalogue_results

    w = warehouse(spark, sf_dir)
    scans = lambda df: plan_of(df).split("== Initial Plan ==")[0].count("Scan parquet")
    declared = CATALOGUE["fact_purchases"]
    own = scans(w.model("fact_purchases", *declared.columns())) + sum(scans(w.model(m, c)) for m, c in set(declared.found_in.values()))
    assert scans(catalogue_results(w, ["fact_purchases"])) <= own


def test_runs_are_stored_by_day(spark, tmp_path):
    path = str(tmp_path / "runs")
    counts = lambda a, b: spark.createDataFrame([("t1", "error", a, None), ("t2", "warn", b, "k")], "test string, severity string, failures long, sample string")
    for at, a, b in ((dt.datetime(2026, 1, 1, 6), 9, 0), (dt.datetime(2026, 1, 1, 9), 1, 0), (dt.datetime(2026, 1, 2, 6), 0, 3)):
        runs = quality.store_run(quality.judged(counts(a, b), at), path)
    assert runs.count() == 4
    assert rows(quality.run_history(runs)) == [("t1", 2, D(2026, 1, 2), "pass", 0, -1), ("t2", 2, D(2026, 1, 1), "warn", 3, 3)]


def test_ledger_checks(spark):
    schema = "transaction_id int, line_number int, ledger_account string, debit decimal(20,6), credit decimal(20,6)"
    from decimal import Decimal as N

    lines = spark.createDataFrame(
        [(1, 0, "a", N("10"), N("0")), (1, 1, "b", N("0"), N("9.995")), (2, 0, "a", N("10"), N("0")),
         (2, 1, "b", N("0"), N("9.98")), (3, 0, "a", N("1"), N("1")), (4, 0, "a", N("0"), N("0"))],
        schema,
    )
    assert rows(quality.double_entry(lines).select("transaction_id")) == [(2,)]
    assert rows(quality.debit_xor_credit(lines).select("transaction_id")) == [(3,)]


def test_volume_anomaly_needs_history(spark):
    days = [("x", D(2026, 1, 1) + dt.timedelta(days=i), 10 + i % 2) for i in range(9)] + [("x", D(2026, 1, 20), 500)]
    got = quality.volume_anomaly(spark.createDataFrame(days, "g string, d date, n int"), "g", "d", "n").orderBy("d").collect()
    assert [r.z_score is None for r in got[:7]] == [True] * 7
    assert [r.anomaly for r in got] == [False] * 9 + [True]
