import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corpusflow.session import get_session

    ckpt = tempfile.mkdtemp(prefix="corpusflow-test-ckpt-")
    s = get_session("local[4]", app="corpusflow-tests", shuffle_partitions=8,
                    conf={"spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
