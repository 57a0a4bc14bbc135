import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from tallyfield.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = local_session("4", shuffle_partitions=4, memory="8g")
    yield spark
    spark.stop()
