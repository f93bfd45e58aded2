from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pairloom.session import local_session

    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def many_chunks(spark):
    """Keeps the range partitions of small inputs apart, so that values must be carried between chunks."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)
