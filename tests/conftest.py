import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tablesync.session import build_session  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def spark():
    root = tempfile.mkdtemp(prefix="tablesync-tests-")
    session = build_session(
        "tablesync-tests",
        f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": f"{root}/checkpoint",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
