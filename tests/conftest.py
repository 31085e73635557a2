import pytest
from pyspark.sql import SparkSession

from marquee.session import configure

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def make_session(cpus: str = "8") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("marquee-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()
