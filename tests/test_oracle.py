"""Every registered query of the library has SQL and gives DuckDB's rows."""

import pytest
from oracle import compare, connect

from quarrykit import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, db, name):
    assert compare(QUERIES[name](spark, SF), db, SQL[name]) is None


def test_each_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_names_are_known_without_a_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "import __spark_entry__ as e; assert len(e.queries()) > 200 and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, check=True)
