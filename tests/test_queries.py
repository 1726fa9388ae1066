"""Every registered query against its SQL."""

import __spark_entry__ as entry
import pytest

from compare import connect, differences
from workload.queries import QUERIES as OWN

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_equals_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), con, ORACLE[name]) is None


# Comparing nothing with nothing proves nothing; these find no fault in the given tables.
FAULTLESS = {"dq_unique_combination"}


def test_no_sql_is_without_rows(con):
    empty = {n for n in OWN if not con.execute(f"SELECT count(*) FROM ({ORACLE[n]})").fetchall()[0][0]}
    assert empty <= FAULTLESS


def test_every_sql_has_a_query():
    assert set(OWN) <= set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == entry.entry(spark).columns
