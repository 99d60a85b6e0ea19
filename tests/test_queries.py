"""Every query with a DuckDB twin gives the same rows; the others give rows."""

import pytest

import __spark_entry__ as contract
from tests.conftest import CHECKED, SMALL
from tools.check_queries import compare, duckdb_on

ORACLE = contract.oracle_sql()
RUNS = contract.queries()
# These fit many models; tests of search and comparison cover them.
LONG = {"compare_models", "model_confidences", "fit_mlp", "fit_mlp_three_outputs", "cv_mlp", "cv_gbt"}


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(CHECKED)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, connection, name):
    problem, rows = compare(spark, connection, CHECKED, name, RUNS[name], ORACLE[name])
    assert problem is None
    assert rows > 0


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(ORACLE) - LONG))
def test_query_without_twin_gives_rows(spark, name):
    assert RUNS[name](spark, SMALL).count() > 0


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() == 1500 and result.where("Age IS NULL").isEmpty()
