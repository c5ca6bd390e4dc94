import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from graincraft.session import session, ship

    s = session("*", 4)
    ship(s)
    yield s
    s.stop()
