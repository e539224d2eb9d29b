import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.session import drop_scratch, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", partitions=4)
    session.sparkContext.setLogLevel("OFF")
    yield session
    drop_scratch(session)
    session.stop()
