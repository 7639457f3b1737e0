"""Every registered query gives the rows of its SQL; stand-ins at least run."""

import pytest

from paperloom.plans import catalog, catalog_more, catalog_runs, registry  # noqa: F401

from .helpers import canonical, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF).toPandas()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    assert canonical(got) == canonical(duck.sql(sql).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert set(registry.queries()) <= set(__spark_entry__.queries())
