"""Every registered query against its DuckDB oracle on the smallest tables,
and no registered plan runs Python per row."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck
from ledgerlake.plans.queries import QUERIES as WAREHOUSE
from planutil import PYTHON_NODES, plan_text

QUERIES = {k: f for k, f in E.queries().items() if k in WAREHOUSE}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, con, name):
    assert name in ORACLE, f"{name} has no oracle"
    ok, msg = compare(spark, name, QUERIES[name], ORACLE[name], sf, con)
    assert ok, msg


# the job and stream queries run whole jobs first and return a stored table
JOB_QUERIES = {"warehouse_build", "dq_failures", "entity_load", "ids_audit", "stream_landing_upsert",
               "stream_bronze_append"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOB_QUERIES))
def test_no_python_in_plan(spark, sf, name):
    plan = plan_text(QUERIES[name](spark, sf), "formatted")
    assert not any(n in plan for n in PYTHON_NODES), plan


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "date_dk" in df.columns
