import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tillguard.session import local_session
    s = local_session(cores=4, shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    import uuid
    from tillguard.session import checkpoint_path
    return checkpoint_path(spark, f"tests/{uuid.uuid4().hex}")
