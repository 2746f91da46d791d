import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from casebook.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="casebook-test-ckpt-")
    session = build_session(master="local[*]", shuffle_partitions=8, extra_conf={"spark.checkpoint.dir": ckpt})
    yield session
    session.stop()


def rows(df, *cols):
    """Collect as a sorted list of tuples (multiset compare)."""
    cols = cols or tuple(df.columns)
    return sortkey_sorted(tuple(r[c] for c in cols) for r in df.collect())


def _key(row):
    return tuple((v is None, "" if v is None else v) for v in row)


def sortkey_sorted(items):
    """Sort tuples by value, NULLs last in each position."""
    return sorted(items, key=_key)
