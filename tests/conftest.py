import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pitchlake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows as sorted tuples; NULL sorts first."""
    return sorted(
        (tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t]
    )
