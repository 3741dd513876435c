"""Every registered query against its SQL on the smallest tables."""

import pytest

from attestry.plans import registry

from .compare import assert_same, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    if name in registry.SQL:
        assert_same(df, con, registry.SQL[name])
    else:
        assert df.columns
        df.limit(1).collect()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
