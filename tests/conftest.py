import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from forecourt.session import build_session, shared_dir

    s = build_session("local[4]", app_name="forecourt-tests", shuffle_partitions=4)
    shared_dir(s)  # uses spark.checkpoint.dir when the environment names one, else a local folder
    yield s
    s.stop()
