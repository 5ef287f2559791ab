import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(root / "shared"),
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.sql.warehouse.dir": str(root / "warehouse"),
    }
    session = build_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def run_dir(tmp_path):
    return str(tmp_path / "run")


def rows(df, *cols):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
