import pytest

from brindle.plans import registry
from tests.compare import compared

ORACLES = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, con, name):
    compared(spark, registry.queries()[name], ORACLES[name], sf_dir, con)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(ORACLES)))
def test_rows(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_the_comparison_can_fail(spark, sf_dir, con):
    with pytest.raises(AssertionError):
        compared(spark, registry.queries()["o1_sort"], ORACLES["o1_sort"].replace("s_acctbal,", "s_acctbal + 1 AS s_acctbal,").replace("SELECT s_suppkey, s_acctbal", "SELECT s_suppkey, s_acctbal + 1 AS s_acctbal"), sf_dir, con)
