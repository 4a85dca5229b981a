"""Every registered query against its DuckDB twin at sf0.001 (the driver's gate, smaller)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "scripts"))

SF = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402

SQL = E.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, name):
    from oracle_check import digest, duck
    a = digest(E.queries()[name](spark, SF).toPandas())
    b = digest(duck(SQL[name], SF))
    assert a[0] == b[0], "columns"
    assert a[1] == b[1], "row count"
    assert a[2] == b[2], f"values differ: {sorted(set(a[3]) ^ set(b[3]))[:4]}"


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(SQL)))
def test_rows_only(spark, name):
    assert E.queries()[name](spark, SF).count() >= 1
