import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from reelspan.session import session

    s = session("local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__sql__session__timeZone="UTC", spark__checkpoint__dir=tempfile.mkdtemp(prefix="spark-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
