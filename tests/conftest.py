import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from corpusmill.cluster import ship

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    return s


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="session")
def data():
    at = Path("/root/testdata/sf0.001")
    if not at.exists():
        pytest.skip("no test tables here")
    return str(at)
