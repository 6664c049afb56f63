import os
import sys
from pathlib import Path

import pytest

TESTS = Path(__file__).resolve().parent
sys.path.insert(0, str(TESTS.parent))
# Tasks import the test modules whose functions they run.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(TESTS.parent), str(TESTS), os.environ.get("PYTHONPATH", "")]
)

from vitaelake.session import spark_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """Rows as sorted tuples, for comparing tables whose order does not matter."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
