import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark import cloudpickle  # noqa: E402

import shapla  # noqa: E402

cloudpickle.register_pickle_by_value(shapla)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{shared}").config("spark.driver.memory", "2g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s
