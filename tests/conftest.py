import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fluelake.runtime import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    d = Path("/root/testdata/sf0.001")
    if not d.exists():
        pytest.skip("no test data")
    return str(d)
