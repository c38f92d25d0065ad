import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from plumbline.session import local_session

    session = local_session(8, partitions=4, memory="8g")
    yield session
    session.stop()
