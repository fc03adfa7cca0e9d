import os
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from icuqm.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # the shared folder can only be named before the session starts
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--conf spark.checkpoint.dir=file://{tmp_path_factory.mktemp('shared')} pyspark-shell")
    session = build_session("icuqm-tests", "UTC", "local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")
