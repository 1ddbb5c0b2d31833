import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="tessera-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]
