import os
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

import pytest  # noqa: E402

from confluo.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.autoBroadcastJoinThreshold": "1m"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
