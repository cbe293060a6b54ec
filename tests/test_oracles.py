"""Every query with a SQL twin gives the twin's rows; the others give rows."""

import pytest

from gridspan import catalog
from tests.oracle import connect, differences
from tests.conftest import CHECK, SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(CHECK)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_twin(spark, duck, name):
    got = catalog.QUERIES[name](spark, CHECK).toPandas()
    assert differences(got, duck.execute(catalog.ORACLES[name]).df()) is None
    assert len(got) > 0


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_runs(spark, name):
    df = catalog.QUERIES[name](spark, SMALL if name.startswith(("d9", "b20", "f11")) else CHECK)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0


def test_entry_points(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
