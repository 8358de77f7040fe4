"""Every registered query against its SQL, at a small scale."""

import oracle_check
import pytest

import __spark_entry__ as contract
from matchspark.queries.catalog import QUERIES
from matchspark.queries.oracle import ORACLE

MODEL_QUERIES = sorted(set(QUERIES) - set(ORACLE))


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    assert oracle_check.compare(df, con, contract.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_query_gives_rows(spark, sf_dir, name):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
