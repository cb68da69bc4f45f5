import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from regiflow.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s


def rows(df, order=None):
    """Collect as list of dicts (small test frames only)."""
    if order:
        df = df.orderBy(*order)
    return [r.asDict(recursive=True) for r in df.collect()]
