import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkloom.session import session

    s = session("local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("shared")))
    yield s
    s.stop()
