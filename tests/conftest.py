from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from rasterweave.session import local_session

    shared = tempfile.mkdtemp(prefix="spark-test-")
    session = local_session(4, **{"spark.checkpoint.dir": f"file://{shared}", "spark.local.dir": shared, "spark.driver.memory": "4g"})
    yield session
    session.stop()
