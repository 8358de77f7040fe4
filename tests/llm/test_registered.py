import oracle_check
import pytest

import __spark_entry__ as contract
from matchspark.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = oracle_check.connect(sf_dir)
    assert oracle_check.compare(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]) == []


def test_all_operators_and_the_pipeline_are_registered():
    numbers = {name.split("_")[0] for name in QUERIES}
    assert numbers == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", ["op1_url_rules", "op4_chat_parts", "op7_entropy_mix"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "Cartesian"))
