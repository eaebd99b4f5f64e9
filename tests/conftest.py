import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("8", 8, **{"spark.driver.memory": "8g", "spark.checkpoint.dir": shared})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
