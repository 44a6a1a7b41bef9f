import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from marketloom.llm.common import reach_workers  # noqa: E402


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)
