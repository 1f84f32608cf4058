import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pedalpath.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 2, "tests", "4g")
    # Shared folder of this run; a cluster names its own.
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pedalpath-test-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{DATA}/events.parquet")
