from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from commerce_lake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=2, shuffle_partitions=2, app="commerce_lake_tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A new scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="cl-test-", dir="/tmp")


def rows(df, *cols, key=None):
    """Collected rows as dicts, sorted for stable comparisons."""
    out = [r.asDict() for r in df.select(*(cols or df.columns)).collect()]
    if key:
        out.sort(key=lambda d: tuple("" if d[k] is None else str(d[k]) for k in ([key] if isinstance(key, str) else key)))
    return out
