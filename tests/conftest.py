from __future__ import annotations

import os
import sys
import uuid
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vouchlake.session import local_session  # noqa: E402

TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
AS_OF = datetime(2026, 3, 4, 5, 6, 7)


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "vouchlake-tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from vouchlake.sinks.store import TableStore

    return TableStore(spark, str(tmp_path / f"tables-{uuid.uuid4().hex}"))


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
