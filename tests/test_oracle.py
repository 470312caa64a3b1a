"""Every registered query with SQL equals it at the smallest scale; the others give rows."""

import pytest

from chainloom.plans import registry
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    assert_same(registry.queries()[name](spark, SF), duck, registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_gives_rows(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
