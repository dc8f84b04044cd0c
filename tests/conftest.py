import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from bourse.session import build_session
    ck = tempfile.mkdtemp(prefix="bourse-test-ck-")
    s = build_session("local[4]", app="bourse-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ck,
                             "spark.sql.streaming.stateStore.providerClass":
                                 "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
