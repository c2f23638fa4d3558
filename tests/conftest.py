import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeretrieve.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, 4)
    shared_dir(session)
    return session
