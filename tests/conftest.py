import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from pulseframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def ts():
    """Timestamp from text."""
    return dt.datetime.fromisoformat


@pytest.fixture
def day():
    return dt.date.fromisoformat
