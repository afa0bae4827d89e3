import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for path in (ROOT, os.path.join(ROOT, "tests")):
    if path not in sys.path:
        sys.path.insert(0, path)
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

from pulsegrid.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df, *columns: sorted(
        (tuple(r) for r in (df.select(*columns) if columns else df).collect()),
        key=lambda t: tuple((v is not None, str(v)) for v in t),
    )
