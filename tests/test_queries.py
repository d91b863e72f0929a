"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracles import ORACLES
from checks.queries import QUERIES as OWN
from tools.compare import connect, differences

#: Optional queries have tests of their own.
QUERIES = {name: query for name, query in queries().items() if name in OWN}
SQL = {name: sql for name, sql in oracle_sql().items() if name in ORACLES}
WITHOUT_SQL = {"layout_2d", "knn_descent"}


@pytest.fixture(scope="module")
def duck(sf):
    with connect(sf) as con:
        yield con


def test_every_query_has_sql_or_its_own_test():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    assert differences(QUERIES[name](spark, sf).toPandas(), duck.execute(SQL[name]).df()) is None


def test_descent_gives_every_vector_its_neighbours(spark, sf):
    found = QUERIES["knn_descent"](spark, sf)
    assert found.count() == 500 * 15 and found.filter("i = j").count() == 0


def test_every_vector_gets_a_place(spark, sf):
    found = QUERIES["layout_2d"](spark, sf)
    assert found.count() == 500 and found.filter("isnan(x) or isnan(y) or x is null or y is null").count() == 0


def test_entry(spark):
    assert entry(spark).filter("level = 'all'").count() == 1
