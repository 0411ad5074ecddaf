import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from citylake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="citylake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
