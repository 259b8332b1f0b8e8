"""Every registered query against its SQL on the smallest tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from gates import ORACLES, QUERIES
from tools.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert differences(spark, db, name, SMALL) == []


def test_entry_points(spark):
    assert entry.entry(spark).count() > 0
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert set(ORACLES) == set(QUERIES)


def test_library_keeps_to_the_rules():
    for path in Path(entry.__file__).parent.glob("tablewright/**/*.py"):
        text = path.read_text()
        assert "localCheckpoint" not in text and "crossJoin" not in text, path
        assert not re.search(r"\.toPandas\(|\.rdd\b|F\.udf\(", text), path
