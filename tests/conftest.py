import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oreflow.sources.scratch import sweep  # noqa: E402
from oreflow.sources.warehouse import Warehouse  # noqa: E402
from tests.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    yield spark
    sweep(spark)
    spark.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))
