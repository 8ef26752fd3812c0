"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import connect, difference
from starmart.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert difference(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) is None


def test_entry_is_the_flagship_query(spark, duck):
    assert difference(entry(spark), duck, oracle_sql()["songplays_fact"]) is None
