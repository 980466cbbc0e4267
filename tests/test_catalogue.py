"""Every registered query against its SQL, at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.catalogue import QUERIES
from checks.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert differences(QUERIES[name].run(spark, SF_DIR), connection, QUERIES[name].sql) is None


def test_contract_lists_the_same_names():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "avg_delay_seconds" in result.columns
