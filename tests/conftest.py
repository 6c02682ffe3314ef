import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from corpusmill.plans.shared import session, ship

    s = session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
