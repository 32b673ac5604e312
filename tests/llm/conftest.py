import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def table_rows():
    import pandas as pd

    return lambda name: pd.read_parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from clickloom.llm.common import ship

    ship(spark)
