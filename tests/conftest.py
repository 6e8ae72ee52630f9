import pytest
from chronotally.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "chronotally-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
