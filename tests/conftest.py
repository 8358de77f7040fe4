import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("matchspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df, *order):
    """Rows as tuples, sorted by all columns or by ``order``."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) for v in r))
