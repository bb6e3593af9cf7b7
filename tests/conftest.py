import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ratings_of(spark):
    """Ratings from ``{user: {item: rating}}``."""

    def build(users):
        rows = [(u, i, float(r)) for u, items in users.items() for i, r in items.items()]
        table = pd.DataFrame(rows, columns=["userId", "movieId", "rating"])
        return spark.createDataFrame(table, "userId int, movieId int, rating double")

    return build


@pytest.fixture(scope="session")
def targets_of(spark):
    def build(*users):
        return spark.createDataFrame([(u,) for u in users], "targetId int")

    return build
