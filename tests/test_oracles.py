"""Every registered query of the library against its SQL, and those without SQL for shape."""

import oracle
import pytest

from sparkloom.plans import registry

registry.load()


@pytest.fixture(scope="module")
def con(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, data, con, name):
    assert oracle.compare(registry.QUERIES[name](spark, data), con, registry.ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, data, name):
    df = registry.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0
