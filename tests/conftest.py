from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from textflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("*", "textflow-tests", memory="8g")


@pytest.fixture
def requests(spark):
    """A DataFrame of requests `id, text`."""
    return lambda *rows: spark.createDataFrame(list(rows), "id string, text string")
