import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from callspark.session import ensure_checkpoint_dir, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8, memory="8g")
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def tuples(df, *order):
    """Rows as plain tuples, sorted."""
    rows = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def plan(df):
    return df._jdf.queryExecution().toString()
