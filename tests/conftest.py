import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from compare import connect, session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
