import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def people(spark):
    """Clean small passenger table with its key, ages filled by the mean."""
    from tabloom.plans.clean import clean
    from tabloom.sources.passengers import passengers
    from tabloom.sources.shared import materialize

    return materialize(clean(passengers(spark, SMALL), "mean", ["PassengerId"]))


@pytest.fixture(scope="session")
def frames(spark, people):
    from tabloom.plans.compare import train_and_test
    from tabloom.sources.shared import materialize

    parts = train_and_test(people, ["PassengerId"], keys=["PassengerId"])
    return [materialize(part) for part in parts]
