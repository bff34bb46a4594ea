import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from claimspark.session import build_session

    return build_session(app_name="claimspark-tests", master="local[4]", shuffle_partitions=8,
                         driver_memory="6g")
