import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cohortgrid.session import get_session

    session = get_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="4g", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse"))
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
