from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import oracle, session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    active = session("4")
    active.conf.set("spark.sql.shuffle.partitions", "4")
    active.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield active
    active.stop()


@pytest.fixture(scope="session")
def fleet(spark):
    from heliospark import config
    return config.fleet(spark)


@pytest.fixture(scope="session")
def duck():
    return oracle(SMALL)


@pytest.fixture(scope="session")
def directory():
    return SMALL
