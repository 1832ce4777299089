import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tiltwatch.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tiltwatch-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.default.parallelism": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
