"""A header table and its children, loaded into one store and published together."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from ledgerflow.operators.skew import semi_join
from ledgerflow.sources.loads import HeaderMark, capture_mark, changed_rows
from ledgerflow.sources.store import BUCKETS, Store, Version

# columns of the audit log, with their types
AUDIT = "execution_id string, table_name string, strategy string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, row_count bigint, error_message string"


def load_family(
    store: Store,
    source: Mapping[str, DataFrame],
    header: str,
    execution_id: str,
    clock=dt.datetime.now,
    mark: HeaderMark | None = None,
    buckets: int = BUCKETS,
) -> Version:
    """Bring a header and its children up to date under one mark; all become visible together, with their audit rows.

    The mark is captured once, from the stored header, before anything is
    written. A first load takes everything. Children of changed headers are
    reloaded whole, and only the buckets of changed headers are rewritten. Where
    a table fails, the old family stays readable and an audit row tells why.
    """
    change = store.change()
    started, done, table = clock(), [], header
    try:
        known = header in change.tables
        if mark is None and known:
            mark = capture_mark(store.read(header, change.base))
        key = mark.key_column if mark else "DocEntry"
        for table in [header, *(t for t in source if t != header)]:
            if mark is None or table not in change.tables:
                change.create(table, source[table], [key], buckets)
                rows, strategy = change.count(table), "full_reload"
            elif table == header:
                rows, strategy = change.replace_by_key(table, changed_rows(source[header], mark)), "upsert"
            else:
                moved = changed_rows(source[header], mark)
                rows, strategy = change.replace_by_key(table, semi_join(source[table], moved, [key])), "via_header"
            done.append(_entry(execution_id, table, strategy, started, clock(), "success", rows))
        return change.commit(done)
    except Exception as error:
        failed = _entry(execution_id, table, "load", started, clock(), "error", None, str(error)[:4000])
        store.change().commit([failed])
        raise


def _entry(execution_id, table, strategy, started, finished, status, rows, message=None) -> dict:
    return {
        "execution_id": execution_id, "table_name": table, "strategy": strategy, "started_at": started.isoformat(),
        "finished_at": finished.isoformat(), "status": status, "row_count": rows, "error_message": message,
    }


def audit_log(store: Store) -> DataFrame:
    """The audit rows of all loads of a store, one per load and table."""
    names = [c.split()[0] for c in AUDIT.split(", ")]

    def value(row: dict, name: str):
        got = row.get(name)
        return dt.datetime.fromisoformat(got) if got and name.endswith("_at") else got

    rows = [tuple(value(r, n) for n in names) for r in store.log() if "execution_id" in r]
    return store.spark.createDataFrame(rows, AUDIT)
