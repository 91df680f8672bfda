from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gatewatch.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="gatewatch-checkpoints-")
    session = build_session(master="local[*]", shuffle_partitions=8, app_name="gatewatch-tests",
                            extra={"spark.checkpoint.dir": shared})
    yield session
    session.stop()
