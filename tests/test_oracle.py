"""Every registered query against its SQL counterpart on the smallest sample."""

from __future__ import annotations

import pytest

import __spark_entry__
from checks.compare import connect, differences
from checks.oracle import ORACLES
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, connection, name):
    assert differences(spark, connection, name, SF) == []


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) == set(ORACLES)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
