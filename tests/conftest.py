from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TESTDATA = Path(os.environ.get("ACQUAINT_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("acquaint-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.01"
    if not path.exists():
        pytest.skip(f"no test data at {path}")
    return str(path)


@pytest.fixture(scope="session")
def small_sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip(f"no test data at {path}")
    return str(path)
