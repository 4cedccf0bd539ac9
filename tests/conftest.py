import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from fieldbook.session import build_session

    session = build_session(
        "local[8]",
        "tests",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="fieldbook-tests-"),
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="fieldbook-warehouse-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df):
    """Rows as sorted tuples, NULLs last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is None, v if v is not None else 0) for v in t])
