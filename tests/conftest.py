import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerloom.session import session

    root = tmp_path_factory.mktemp("spark")
    s = session(
        "tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(root / "warehouse"), "spark.checkpoint.dir": str(root / "shared"),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
