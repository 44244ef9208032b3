import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "America/New_York")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from textward.plans.session import ship_package

    ship_package(session)
    return session


@pytest.fixture
def rows(spark):
    """``rows([...], "ddl")`` -> DataFrame."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def small():
    return SMALL


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
