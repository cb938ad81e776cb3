"""Every registered query against its SQL on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = oracle(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", oracle_sql())
def test_query_agrees_with_its_sql(spark, database, name):
    mine = queries()[name](spark, SF).toPandas()
    assert difference(mine, database.execute(oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry(spark).count() > 0
