"""Every registered query against its SQL oracle, on whole tables."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


def test_every_query_of_the_checks_has_an_oracle():
    """Some text operators cannot be expressed in SQL; their own tests compare them by brute force."""
    text_operators = {n for n in queries() if re.match(r"op\d+_|pipeline$", n)}
    assert set(queries()) - text_operators <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, duck, name):
    _, problem = compare(queries()[name](spark, SF_DIR), oracle_sql()[name], duck)
    assert problem is None


def test_entry_has_findings(spark):
    assert entry(spark).count() > 0
