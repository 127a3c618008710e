import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the library shipped to its workers."""
    from tessera.llm.common import ship
    ship(spark)
    return spark
