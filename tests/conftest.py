from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

import compare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = compare.session()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    return compare.duck(SMALL)


@pytest.fixture()
def frame(spark):
    """Frame from rows with an explicit schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
