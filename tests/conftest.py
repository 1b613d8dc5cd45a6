import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from millrace.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(8, spark__checkpoint__dir=str(home / "shared"), spark__sql__warehouse__dir=str(home / "warehouse"))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return lambda name: str(tmp_path / name)


def rows(df):
    """Rows as a sorted list of tuples, columns by name."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
