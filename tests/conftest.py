import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cowrie import session as cowrie_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return cowrie_session.configure(spark)


@pytest.fixture
def rows(spark):
    """``rows(ddl, tuple, tuple, …)``: a DataFrame of hand-written rows."""

    def build(ddl, *values):
        return spark.createDataFrame(list(values), ddl)

    return build


def day(text: str) -> date:
    return date.fromisoformat(text)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def as_set(df) -> set:
    collected = [tuple(r) for r in df.collect()]
    assert len(collected) == len(set(collected)), "repeated rows"
    return set(collected)
