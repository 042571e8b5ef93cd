import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from cohortmart.session import build_session
    s = build_session("local[4]", app="cohortmart-tests", shuffle_partitions=4,
                      **{"spark.sql.shuffle.partitions": "4"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortmart-test-ckpt-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
