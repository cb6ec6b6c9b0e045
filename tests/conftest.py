import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from wellspring.session import checkpoint_root, get_session

    s = get_session(
        app_name="wellspring-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '*')}]",
        shuffle_partitions=8,
        extra_conf={"spark.driver.memory": "8g"},
    )
    checkpoint_root(s)  # unset in tests: a private folder is registered
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
