import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from clickflow.session import local_session
    s = local_session("*", shuffle_partitions=8, app="clickflow-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def _key(t):
    return tuple("" if v is None else str(v) for v in t)


def srt(items):
    """Expected rows in the order ``rows`` returns them."""
    return sorted((tuple(t) for t in items), key=_key)


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns)."""
    d = df.select(*cols) if cols else df
    return srt(tuple(r) for r in d.collect())


def plan_text(df) -> str:
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
