import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import build_session

    session = build_session(
        "tests", "local[4]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
