import os
import signal
import sys

# Before numpy is loaded: its threads do not survive the fork that starts Spark.
for threads in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
    os.environ.setdefault(threads, "1")

import pytest  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sparkloom.session import build_session  # noqa: E402

TEST_SECONDS = 600


@pytest.fixture(autouse=True)
def time_limit(request):
    """A test that takes longer fails instead of holding up the others."""

    def stop(*_):
        raise TimeoutError(f"{request.node.nodeid} took over {TEST_SECONDS} s")

    before = signal.signal(signal.SIGALRM, stop)
    signal.alarm(TEST_SECONDS)
    yield
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "sparkloom-tests",
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
