import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from sparkbourse.operators.running import MAX_GROUP_CONF  # noqa: E402
from sparkbourse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_groups(spark):
    """Make every key with more than a few rows a hot one."""

    def limit(rows: int) -> None:
        spark.conf.set(MAX_GROUP_CONF, str(rows))

    yield limit
    spark.conf.unset(MAX_GROUP_CONF)
