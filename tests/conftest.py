import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adsentry.session import build_session, ensure_checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="adsentry-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # Tests only: a checkpoint folder of our own when the session names none.
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="adsentry-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="adsentry-test-")


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all columns by default)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
