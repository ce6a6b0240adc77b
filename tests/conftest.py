import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from winnow.session import local_session  # noqa: E402
from winnow.workers import reach  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=8, memory="4g", partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield reach(s)
    s.stop()
