"""Every query of the workload against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import connect, spark_rows, sql_rows
from workload.oracle import ORACLE
from workload.spark_queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, plan, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    for unwanted in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in text
    # Only totals over everything end in one task, which gets one row from each other task.
    assert "SinglePartition" not in text or name == "conform_losses"
    columns, wanted = sql_rows(connection, ORACLE[name])
    assert sorted(df.columns) == columns
    assert spark_rows(df) == wanted


def test_entry(spark):
    assert entry(spark).count() > 0


def test_what_is_optional_does_not_take_the_rest_down(monkeypatch, capsys):
    import sys

    import __spark_entry__ as entry_module

    assert entry_module._optional("strata.no_such_package") is None
    monkeypatch.setitem(sys.modules, "duckdb", None)  # a module that another one needs is missing
    monkeypatch.delitem(sys.modules, "check", raising=False)
    assert entry_module._optional("check") is None
    assert "without check" in capsys.readouterr().err
