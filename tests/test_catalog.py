"""Every registered query against its SQL on the given tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tidemark import catalog
from tests.compare import difference, duck, type_difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sf_dir, con, name):
    df, sql = entry.queries()[name](spark, sf_dir), entry.oracle_sql()[name]
    assert type_difference(df, con, sql) is None
    assert difference(df, con, sql) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_missing_dependency_costs_its_own_queries_only():
    """Without the tokenizers' files the training-data queries are gone, and no other."""
    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    assert done.stdout.split() == sorted(catalog.QUERIES)
