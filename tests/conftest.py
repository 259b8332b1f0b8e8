import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tablewright import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[*]",
        spark_sql_shuffle_partitions="8",
        spark_ui_enabled="false",
        spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from a DDL schema and rows."""

    def build(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return build


def plain(value):
    """Rows and lists as tuples and lists, so that results compare with ==."""
    if isinstance(value, tuple):
        return tuple(plain(v) for v in value)
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


@pytest.fixture
def rows():
    """The rows of a DataFrame as plain tuples, in a stable order."""

    def collect(df, ordered=False):
        found = [plain(tuple(r)) for r in df.collect()]
        return found if ordered else sorted(found, key=repr)

    return collect


@pytest.fixture
def folder(tmp_path):
    return lambda name="out": str(tmp_path / name)
