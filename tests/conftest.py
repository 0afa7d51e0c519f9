import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpusprep.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def at_scale(monkeypatch):
    """Take the paths for large inputs: tiny stretches, no broadcasts, salted hot keys."""
    from corpusprep.operators import lookup, scan

    monkeypatch.setattr(scan, "WHOLE_BYTES", -1)
    monkeypatch.setattr(scan, "BITS", 6)
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(lookup, "HOT_ROWS", 5)
    monkeypatch.setattr(lookup, "SALTS", 4)
