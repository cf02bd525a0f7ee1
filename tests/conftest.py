from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyshelf import session


@pytest.fixture(scope="session")
def spark():
    s = session.local_session(4, "tallyshelf-tests")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
