import pytest

from clicksieve.schema import EVENT_SCHEMA
from clicksieve.session import build_session

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "2",
            # Compiling code takes longer than the few rows here do without.
            "spark.sql.codegen.wholeStage": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Makes an event frame of (event_type, uid, timestamp, ip, impression_id) rows, numbered in order."""

    def make(rows):
        return spark.createDataFrame([(i, *row) for i, row in enumerate(rows, 1)], EVENT_SCHEMA)

    return make


def seqs(df):
    return sorted(row["seq"] for row in df.select("seq").collect())
