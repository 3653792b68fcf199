from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ordermill.session import build_session, use_checkpoint_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield use_checkpoint_folder(session)
    session.stop()
