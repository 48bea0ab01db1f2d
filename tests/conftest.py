from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from shelfwise.session import new_folder

    return new_folder(spark, "test")
