import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from starmart.session import local_session

    s = local_session("*", 8, app="starmart-tests")
    yield s


def ts(s):
    import datetime as dt

    return dt.datetime.fromisoformat(s)
