import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from sigmill.session import build_session

    s = build_session("local[4]", "tests", 4, spark__driver__memory="6g")
    yield s
    s.stop()
