from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from assayweave.session import recommended_conf


def make_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("assayweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return make_session()
