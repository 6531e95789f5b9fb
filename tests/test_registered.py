"""Every registered query against its SQL; those without SQL must run and return rows."""

import re

import pytest

from check import compare, database
from millrace.plans import all_queries

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con(root):
    return database(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, root, name):
    ok, note = compare(spark, con, QUERIES[name], root)
    assert ok, note


def test_names_and_coverage():
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", n) for n in QUERIES)
    assert all(q.covers for q in QUERIES.values())
