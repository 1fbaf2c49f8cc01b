"""Every query of the library against its SQL."""

import pytest

from spanloom.plans.oracle import SQL
from spanloom.plans.queries import QUERIES

from .compare import rows_of, sql_rows


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    names, got = rows_of(df.columns, df.collect())
    wanted_names, wanted = sql_rows(sf_dir, SQL[name])
    assert names == wanted_names
    assert got == wanted, (len(got), len(wanted), list((got - wanted).items())[:2], list((wanted - got).items())[:2])
