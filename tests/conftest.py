import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from postlytics.session import get_session
    session = get_session("local[*]", app="postlytics-tests", shuffle_partitions=8,
                          **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="postlytics-warehouse-")})
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        # tests only: pick a scratch folder when the deployment names none
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="postlytics-tests-"))
    yield session
    session.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]
