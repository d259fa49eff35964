import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
os.environ["PYTHONPATH"] = os.pathsep.join(
    [str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])]
)

from canton.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def rows():
    """Collected rows as plain tuples, sorted."""
    def collect(df, *columns):
        out = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in out.collect()), key=repr)

    return collect
