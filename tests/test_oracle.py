"""Every registered query against the same result in SQL."""

import pytest

from checks.compare import connect, difference
from checks.oracle import oracle_sql
from checks.queries import queries


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.fixture(scope="module", params=["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def folder(request):
    return request.param, connect(request.param)


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_as_sql(spark, folder, name):
    sf_dir, connection = folder
    assert difference(queries()[name](spark, sf_dir), connection, oracle_sql()[name]) is None
