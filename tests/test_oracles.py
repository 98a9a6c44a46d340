"""Every registered query against its independent SQL, on the smallest data."""

from __future__ import annotations

import pytest

from tests.compare import connect, difference
from tests.conftest import SF
from turnero.plans import oracle, queries


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(queries.PLANS) == set(oracle.STATEMENTS)


@pytest.mark.parametrize("name", sorted(queries.PLANS))
def test_matches_oracle(spark, duck, name):
    assert difference(spark, duck, SF, name) is None
