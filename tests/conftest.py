from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))



@pytest.fixture(scope="session")
def spark():
    from starloom.session import get_session

    s = get_session("local[8]", app_name="starloom-tests", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()
