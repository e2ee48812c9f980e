import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

from weftline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("weftline-tests", "8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    import samples

    return samples.Samples(spark)
