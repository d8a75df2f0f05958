"""Every registered query against its check SQL on the same tables."""

from __future__ import annotations

import math
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerflow.entries.registry import QUERIES
from ledgerflow.session import work_folder

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# the corpus queries are tested in tests/llm
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def checker(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_check_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry_without_a_module_of_the_corpus_queries():
    """Where a module is missing that only the corpus operators need, the other queries are all there."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[1], check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES))]


def test_work_folder_is_never_local_on_a_cluster():
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session(spark_master="spark://host:7077"))
    assert work_folder(session(spark_master="spark://host:7077", spark_checkpoint_dir="hdfs://store/work/")) == "hdfs://store/work"
    assert work_folder(session(spark_master="local[4]")) == work_folder(session(spark_master="local[4]"))


def test_registered_queries_read_given_tables(spark, sf_dir):
    """No registered staging list is made of literal rows."""
    for key in ("stg_price_list_opln", "stg_additional_expense_oexd", "stg_fiscal_usage_ousg"):
        plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Scan parquet" in plan and "LocalTableScan" not in plan, key


def test_entry(spark):
    assert entry(spark).columns == ["month", "presale_channel", "net_revenue", "gross_profit", "line_count"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_check_sql(spark, sf_dir, checker, key):
    df = queries()[key](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas") if bad in plan]
    cursor = checker.execute(oracle_sql()[key])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.columns, df.collect()) == _sorted(columns, cursor.fetchall())
