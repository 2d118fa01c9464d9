"""Every registered query returns the rows of its SQL twin."""

import pytest
from conftest import SF

from millrace.compare import compare
from millrace.plans import ORACLES, QUERIES

STREAMS = [n for n in QUERIES if n.startswith("stream_")]


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_batch_query(spark, name):
    problem, rows = compare(QUERIES[name](spark, SF), ORACLES[name], SF)
    assert problem is None
    assert rows > 0


@pytest.mark.parametrize("name", STREAMS)
def test_stream_query(spark, name):
    problem, rows = compare(QUERIES[name](spark, SF), ORACLES[name], SF)
    assert problem is None
    assert rows > 0
