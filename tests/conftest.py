from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


def rows(df) -> list[tuple]:
    """Rows as sorted plain tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
