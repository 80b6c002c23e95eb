import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = str(Path(__file__).resolve().parent.parent) + ":" + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from manualmill.session import get_spark

    s = get_spark(8, 4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
