from __future__ import annotations

import pytest

from briefloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="8g", partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    return session
