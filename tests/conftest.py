import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wavepanel.session import build_session
    s = build_session("local[4]", app="wavepanel-tests", shuffle_partitions=4)
    # Tests run locally, so they may set their own checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wp-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def low_limit(spark):
    """Force the hot-key (segmented) path: every key above 7 rows is hot."""
    from wavepanel.session import ROWS_PER_SEGMENT_KEY
    spark.conf.set(ROWS_PER_SEGMENT_KEY, "7")
    yield 7
    spark.conf.unset(ROWS_PER_SEGMENT_KEY)
