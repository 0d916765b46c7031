import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from unfurl.session import local_session
    s = local_session(4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def plan_text(df, mode="formatted"):
    """The text ``df.explain(mode)`` prints."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
