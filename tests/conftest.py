import sys
from pathlib import Path

import pytest
from support import GOOD_TRIP

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from curbside.plans import build_session  # noqa: E402
from curbside.sources import TRIP_SCHEMA  # noqa: E402

@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[*]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="10000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_trips(spark):
    """Trips from overrides of one plausible trip, one dict per row."""

    def make(*rows):
        data = [tuple({**GOOD_TRIP, **row}[name] for name in TRIP_SCHEMA.names) for row in rows]
        return spark.createDataFrame(data, TRIP_SCHEMA)

    return make


@pytest.fixture(scope="session")
def plan_of():
    """The executed physical plan as text, after running the query."""

    def text(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
