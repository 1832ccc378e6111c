from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from sievewright.session import configure


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("sievewright-tests")
    session = (
        configure(builder)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
