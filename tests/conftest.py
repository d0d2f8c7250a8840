import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from creditmill.session import builder

    session = (builder("tests").master("local[8]").config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
