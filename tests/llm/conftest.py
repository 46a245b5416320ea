import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(autouse=True)
def _package_on_workers(spark):
    from corpusprep.llm.common import for_workers

    for_workers(spark)
