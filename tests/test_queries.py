"""Every core query against its SQL, and the entry point."""

import pytest
from oracle_compare import compare, duck

from tarnlake.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    said = compare(spark, con, name, registry.queries()[name], registry.oracle_sql().get(name), SF)
    assert said.startswith(("equal", "rows")), said


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
