from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tabulark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", partitions=8)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(params=["1", "16"])
def widths(request, spark):
    """Runs a test with few and with many shuffle partitions."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield int(request.param)
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def sf() -> str:
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
