"""Every registered query against equivalent SQL (or, without SQL, at least rows)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle import compare

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    ok, message = compare(spark, name, FOLDER)
    assert ok, message


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
