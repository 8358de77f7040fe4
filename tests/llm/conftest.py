import pytest


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """Scratch tables of these tests go to pytest's own folder."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
