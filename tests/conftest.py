import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pricelens.session import build_session

    session = build_session("pricelens-tests", master="local[8]", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()
