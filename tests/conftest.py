import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidewater.session import build_session, checkpoint_dir

    s = build_session("local[4]", 4, app_name="tidewater-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples, sorted."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
