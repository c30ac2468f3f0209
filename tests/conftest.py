import datetime as dt
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from rodovia.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = configure(
        SparkSession.builder.master("local[4]").appName("tests"),
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g",
           # Tiny inputs: compiling generated code would take longer than running it.
           "spark.sql.codegen.wholeStage": "false",
           "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1", "spark.python.sql.dataFrameDebugging.enabled": "false",
           "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


AS_OF = dt.date(2026, 6, 15)
RUN_TS = dt.datetime(2026, 6, 15, 2, 0)


def at(days: int, hour: int = 0) -> dt.datetime:
    """Midnight (or ``hour``) of the day ``days`` from the reference date."""
    return dt.datetime.combine(AS_OF + dt.timedelta(days=days), dt.time(hour))


def on(days: int) -> dt.date:
    return AS_OF + dt.timedelta(days=days)
