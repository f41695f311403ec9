import pytest

from cinderlake.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "cinderlake-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def plan_text():
    """The executed plan of a frame as text, with adaptive execution left out."""

    def text(df):
        spark = df.sparkSession
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            again = df.select("*")
            return again._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")

    return text
