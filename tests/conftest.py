import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from aurum.config import get_spark
    # catalog tables go to a scratch warehouse, never into the working tree
    s = get_spark("tests", cpus=4, shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="aurum-wh-")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleaned with rm)."""
    return tempfile.mkdtemp(prefix="aurum-test-")


@pytest.fixture(scope="session")
def settings():
    import datetime as dt

    from aurum.config import Settings
    return Settings(salt="test-salt", as_of=dt.date(2001, 8, 15))
