import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkmart.runtime import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    extra = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))}
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", **extra})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
