import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from provisio.session import build_session, checkpoint_dir

    s = build_session("local[4]", shuffle_partitions=8)
    checkpoint_dir(s)   # spark.checkpoint.dir from the session; a fresh local folder only when unset
    yield s
    s.stop()


def rows(df, *cols):
    """Collect selected columns as a list of tuples."""
    return [tuple(r[c] for c in cols) for r in df.collect()]
