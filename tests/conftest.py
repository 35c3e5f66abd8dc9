import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from tarnlake.session import build_session

    s = build_session(master="local[4]", spark_sql_shuffle_partitions="4", spark_driver_memory="4g", spark_ui_enabled="false", spark_ui_showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
