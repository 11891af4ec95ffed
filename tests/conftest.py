import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quiver.session import build_session, checkpoint_dir

    session = build_session("local[*]", app_name="quiver-tests", shuffle_partitions=8)
    # Uses spark.checkpoint.dir when the environment names one; only an
    # unset local session gets a folder of its own.
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def edges_of(spark):
    def make(pairs):
        return spark.createDataFrame(list(pairs), "follower bigint, followee bigint")

    return make


@pytest.fixture(scope="session")
def view_small(spark):
    from quiver.sources import edge_view

    return edge_view(spark, SF0001)
