import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import build_session, release

    ck = tempfile.mkdtemp(prefix="tidepool-test-ck-")
    s = build_session("local[4]", 8, app_name="tidepool-tests",
                      extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": ck})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    release(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidepool-test-")
