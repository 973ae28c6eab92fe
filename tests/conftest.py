import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from skeinwork.session import get_spark

    session = get_spark("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="3g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__sql__warehouse__dir="/tmp/skeinwork-warehouse")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
