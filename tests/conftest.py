import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tallyflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tallyflow-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false", "spark.sql.codegen.wholeStage": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    from tallyflow.sources.lake import Lake

    return Lake(spark, str(tmp_path / "lake"))
