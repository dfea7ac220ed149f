"""Every query with an SQL twin gives the same rows as DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from compare import rows

from tabulark.plans import REGISTRY

CHECKED = sorted(n for n, q in REGISTRY.items() if q.sql is not None)


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_same_rows(spark, duck, sf, name):
    found = REGISTRY[name].build(spark, sf).toPandas()
    wanted = duck.execute(REGISTRY[name].sql).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)
