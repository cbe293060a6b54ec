import pytest

from gridspan import build_session

SMALL = "/root/testdata/sf0.001"
CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
