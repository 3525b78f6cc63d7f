"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import differences, duck

from trueledger import registry

registry.load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, sf_dir, con, name):
    _, problems = differences(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLES[name])
    assert not problems


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs_without_sql(spark, sf_dir, name):
    assert registry.QUERIES[name](spark, sf_dir).count() > 0


def test_comparison_sees_a_wrong_value(spark, con):
    df = spark.sql("SELECT 1 AS a, CAST(2 AS DECIMAL(10,2)) AS b")
    assert differences(df, con, "SELECT 1 AS a, CAST(2 AS DECIMAL(10,2)) AS b")[1] == []
    assert differences(df, con, "SELECT 1 AS a, CAST(2.01 AS DECIMAL(10,2)) AS b")[1]
    assert differences(df, con, "SELECT 1 AS a, CAST(2 AS DOUBLE) AS b")[1]
    assert differences(df, con, "SELECT 1 AS a, CAST(2 AS DECIMAL(10,2)) AS c")[1]
