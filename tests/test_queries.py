"""Every registered query against its SQL on the same table."""

import sys
from pathlib import Path

import pytest
from conftest import SF

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sluicegate.plans.oracle import ORACLE  # noqa: E402
from sluicegate.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{SF}/events.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    assert sorted(frame.columns) == sorted(columns)
    found = [tuple(r) for r in frame.select(*columns).collect()]
    wanted = expected.fetchall()
    assert len(found) == len(wanted)
    assert in_order(found) == in_order(wanted)
