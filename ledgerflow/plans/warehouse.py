"""The warehouse: named models over raw tables, composed lazily."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerflow.contract import COLUMNS, conform
from ledgerflow.operators.skew import join_lines_to_headers
from ledgerflow.sources.staging import STAGING, mapping, project


@dataclass(frozen=True)
class Params:
    """Run parameters; the defaults are the business rules' own values."""

    as_of: dt.date = dt.date(2026, 1, 1)
    run_date: dt.date = dt.date(2026, 1, 1)
    goal_min_year: int = 2024
    goal_mart_min_year: int = 2025
    bridge_floor: dt.date = dt.date(2025, 1, 1)
    bridge_default: dt.date = dt.date(2025, 10, 1)
    price_list: int = 100
    calendar_start: dt.date = dt.date(2023, 1, 1)
    calendar_end: dt.date = dt.date(2035, 12, 31)


# a raw table with frames joined to its rows by a raw column each, labels left, headers inner; None where the source
# has no such way
Labelled = Callable[[str, Mapping[str, DataFrame], Mapping[str, tuple[str, DataFrame]]], DataFrame | None]
Builder = Callable[["Warehouse", set[str]], DataFrame]
BUILDERS: dict[str, Builder] = {}


def model(name: str) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        BUILDERS[name] = build
        return build

    return register


class Warehouse:
    """Resolves raw tables, staging projections and models by name.

    A model can be asked for some of its columns only; builders then leave out
    the lookups nobody needs, so a fact does not pay for labels it drops.
    """

    def __init__(
        self, raw: Callable[[str], DataFrame], params: Params | None = None, labelled: Labelled | None = None
    ):
        self._raw = raw
        self._labelled = labelled
        self.params = params or Params()
        self._cache: dict[tuple, DataFrame] = {}

    def _once(self, key: tuple, make: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._cache:
            self._cache[key] = make()
        return self._cache[key]

    def raw(self, name: str) -> DataFrame:
        return self._once(("raw", name), lambda: self._raw(name))

    def stage(self, name: str) -> DataFrame:
        return self._once(("stage", name), lambda: project(self.raw(STAGING[name][0]), name))

    def stage_labelled(
        self, name: str, labels: Mapping[str, DataFrame], headers: Mapping[str, DataFrame] | None = None
    ) -> DataFrame:
        """Staging projection `name`, left-joined to frames that share one of its columns: column -> frame.

        Of `headers`, given the same way, a line has to have one. Where the source can join its
        rows before it shapes them into the raw table, the joins shuffle those.
        """
        headers = headers or {}
        source = {staged: column for column, staged, rule in mapping(name) if not rule}
        if (labels or headers) and self._labelled and labels.keys() | headers.keys() <= source.keys():
            renamed = {source[key]: label.withColumnRenamed(key, source[key]) for key, label in labels.items()}
            rows = self._labelled(STAGING[name][0], renamed, {source[key]: (key, header) for key, header in headers.items()})
            if rows is not None:
                joined = (*headers.items(), *labels.items())
                return project(rows, name, *(c for key, frame in joined for c in frame.columns if c != key))
        staged = self.stage(name)
        for key, header in headers.items():
            staged = join_lines_to_headers(staged, header, [key])
        for key, label in labels.items():
            staged = staged.join(label, key, "left")
        return staged

    def model(self, name: str, *columns: str) -> DataFrame:
        wanted = list(columns) or COLUMNS[name]

        def make() -> DataFrame:
            if (given := self._cache.get(("given", name))) is not None:
                return given.select(*wanted)
            return conform(BUILDERS[name](self, set(wanted)), name, wanted)

        return self._once(("model", name, tuple(wanted)), make)

    def lines_of(self, name: str, columns: Sequence[str], headers: DataFrame, key: str) -> DataFrame:
        """Columns of a model of lines, inner-joined to their headers on `key`."""
        if ("given", name) in self._cache:
            return join_lines_to_headers(self.model(name, *columns), headers, [key])
        rows = BUILDERS[name](self, set(columns), {key: headers})
        return conform(rows, name, [*columns], [c for c in headers.columns if c != key])

    def use(self, name: str, table: DataFrame) -> None:
        """Let later models read `name` from a stored table instead of rebuilding it."""
        self._cache[("given", name)] = table
        for key in [k for k in self._cache if k[0] == "model"]:
            del self._cache[key]
