import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "3g"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
