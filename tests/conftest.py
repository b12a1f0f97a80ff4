import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vaultmart.session import get_session, shared_dir

    s = get_session("local[*]", app_name="vaultmart-tests", shuffle_partitions=8)
    shared_dir(s)  # sets a checkpoint folder only when the session has none
    yield s
    s.stop()


@pytest.fixture(scope="session")
def run(spark):
    """Batches 1-3 at sf0.001, then batch 4 = the feed of batch 3 sent again."""
    from vaultmart.plans.pipeline import Pipeline

    p = Pipeline(spark, SF_SMALL, buckets=8, keep_open=None)
    p.run(batches=(1, 2, 3), marts_for=(3,))
    p.run_batch(4, with_marts=False, feed=3)
    return p
