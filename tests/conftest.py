from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rollcall import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build(
        "rollcall-tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
